"""Wide serving tables: a fact with its dimensions, joined on keys that never change its row count.

Conferences join on (team, season), never on the team alone.  Join strategies are left to AQE: it
broadcasts a dimension by the size it measures, and merges where the dimension has grown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_dimension(df: DataFrame, dim: DataFrame, on: dict[str, str], columns: dict[str, str], spread: str | None = None) -> DataFrame:
    """df left-joined to dim (unique on its keys): on maps df's columns to dim's, columns dim's to new names.

    Most rows may have no key.  Where dim is too large to be broadcast, all of those would meet in one task;
    with spread (a column whose values differ) they are dealt by its hash instead, and match nothing.
    """
    keyed = dim.select(*[F.col(d).alias(f"el_{i}") for i, d in enumerate(on.values())], *[F.col(c).alias(n) for c, n in columns.items()])
    match = [F.col(c) == F.col(f"el_{i}") for i, c in enumerate(on)]
    if spread is not None:
        ((c, _),) = on.items()
        dealt = F.coalesce(F.col(c), (-1 - F.pmod(F.xxhash64(spread), F.lit(1 << 16))).cast(df.schema[c].dataType))
        match = [dealt == F.col("el_0"), F.col(c).isNotNull()]
    return df.join(keyed, match, "left").drop(*[f"el_{i}" for i in range(len(on))])


def game_secs_remaining(period: str = "period", clock: str = "clock_secs_period") -> Column:
    p, c = F.col(period), F.col(clock)
    return F.when(p.isNull() | c.isNull(), None).when(p > 4, 0).otherwise((4 - p) * 900 + c)


def is_clutch(score_diff: str, period: str = "period", clock: str = "clock_secs_period") -> Column:
    """Last five minutes of the fourth period or later, within one score; unknown where that depends on a null."""
    p = F.col(period)
    return (p >= 4) & (F.abs(F.col(score_diff)) <= 8) & ((p > 4) | (F.col(clock) <= 300))


def distance_floor(value: str, width: int = 5, low: int = 20, high: int = 60) -> Column:
    """Bands by floor: everything below low in one, everything from high on in one."""
    d = F.col(value)
    return F.when(d < low, low - width).when(d >= high, high).otherwise((F.floor(d / width) * width).cast("int"))


def distance_bucket(down: str = "down", distance: str = "distance") -> Column:
    d = F.col(distance)
    return F.when(F.col(down).isNull() | d.isNull(), None).when(d <= 3, "short").when(d <= 7, "medium").otherwise("long")


def field_zone(yards_to_goal: str = "yards_to_goal") -> Column:
    y = F.col(yards_to_goal)
    return F.when(y.isNull(), None).when(y <= 20, "red zone").when(y <= 50, "opponent half").otherwise("own half")


def _sides(df: DataFrame, teams: DataFrame, team_seasons: DataFrame, sides: tuple[str, str]) -> DataFrame:
    for s in sides:
        df = with_dimension(df, teams, {f"{s}_team_id": "team_id"}, {"display_name": f"{s}_team"})
        df = with_dimension(df, team_seasons, {f"{s}_team_id": "team_id", "season": "season"}, {"conference_name": f"{s}_conference", "ncaa_division": f"{s}_division"})
    return df.withColumn("both_top_division", (F.col(f"{sides[0]}_division") == "FBS") & (F.col(f"{sides[1]}_division") == "FBS"))


def play_wide(kicks: DataFrame, venues: DataFrame, teams: DataFrame, team_seasons: DataFrame, athletes: DataFrame) -> DataFrame:
    """The kicks fact with venue, both teams, both conferences of that season, the kicker, and derived columns."""
    df = with_dimension(kicks, venues, {"venue_id": "venue_id"}, {"venue_name": "venue_name", "city": "venue_city", "state": "venue_state", "surface": "surface", "indoor": "venue_indoor"})
    df = _sides(df, teams, team_seasons, ("kicking", "receiving"))
    df = with_dimension(df, athletes, {"kicker_athlete_id": "athlete_id"}, {"known_name": "kicker_known_name", "name_confidence": "kicker_name_confidence", "position": "kicker_position"})
    return df.withColumns({
        "game_secs_remaining": game_secs_remaining(), "is_clutch": is_clutch("score_diff_kicking"),
        "fg_dist_bucket": distance_floor("fg_distance_yds"), "game_month": F.month("kickoff_utc"),
    })


def scrimmage_wide(scrimmage: DataFrame, venues: DataFrame, teams: DataFrame, team_seasons: DataFrame, athletes: DataFrame) -> DataFrame:
    """The scrimmage fact with venue, both sides, four people by role, and derived columns."""
    df = with_dimension(scrimmage, venues, {"venue_id": "venue_id"}, {"venue_name": "venue_name", "surface": "surface", "indoor": "venue_indoor"})
    df = _sides(df, teams, team_seasons, ("offense", "defense"))
    for role in ("passer", "rusher", "receiver", "tackler"):
        df = with_dimension(df, athletes, {f"{role}_athlete_id": "athlete_id"}, {"known_name": f"{role}_name"}, spread="play_uid")
    return df.withColumns({
        "game_secs_remaining": game_secs_remaining(), "is_clutch": is_clutch("score_diff_offense"),
        "distance_bucket": distance_bucket(), "field_zone": field_zone(), "game_month": F.month("kickoff_utc"),
    })


def latest_only(team_seasons: DataFrame) -> DataFrame:
    """Each team's latest row: the deliberate wrong answer for plays of earlier seasons, kept to show the trap."""
    return team_seasons.groupBy("team_id").agg(F.max_by("conference_name", "season").alias("latest_conference"))
