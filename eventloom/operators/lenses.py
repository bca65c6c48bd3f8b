"""Lenses: one column vocabulary over the facts, told from a subject's side.

The kicks lens tells a kick from the kicking team; the scrimmage lens a play from the offense or, with
signs turned, from the defense.  The order of the outcome branches is the specification.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YARD_LIMIT = 110
CONVERSIONS = ("pat", "two_point", "defensive_conversion")


def stated(flag: str) -> Column:
    """True only where the flag is stated and true."""
    return F.coalesce(F.col(flag), F.lit(False))


def possible_yards(limit: int = YARD_LIMIT) -> Column:
    """Yards gained; null where no play can gain so many."""
    return F.when(F.abs("yards_gained") <= limit, F.col("yards_gained"))


def first_true(branches: list[tuple[Column, str]], otherwise: str) -> Column:
    chain = None
    for test, label in branches:
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(otherwise)


def kick_outcome() -> Column:
    """Three families of kicks; an outcome nobody stated is Unknown, a negated field goal is no miss."""
    tried = [(F.col("converted").isNull(), "Unknown"), (F.col("converted"), "Converted"), (stated("kick_blocked"), "Blocked")]
    placed = [(F.col("fg_made").isNull(), "Negated"), (F.col("fg_made"), "Made"), (stated("kick_blocked"), "Blocked")]
    away = [
        (stated("onside"), "Onside"), (F.col("returned").isNull(), "Unknown"), (stated("kick_blocked"), "Blocked"), (stated("touchback"), "Touchback"),
        (stated("fair_catch"), "Fair catch"), (stated("out_of_bounds"), "Out of bounds"), (stated("downed"), "Downed"), (F.col("returned"), "Returned"),
    ]
    kind = F.col("play_kind")
    return F.when(kind.isin(*CONVERSIONS), first_true(tried, "Failed")).when(kind == "field_goal", first_true(placed, "Missed")).otherwise(first_true(away, "Unknown"))


def scrimmage_outcome(side: str, yards: Column) -> Column:
    """A turnover is told before a touchdown, so one returned for a score is the other side's."""
    offense = side == "offense"
    away = F.coalesce("points_scored", F.lit(0)) < 0
    branches = [
        (F.col("is_penalty"), "Penalty"),
        (F.col("is_turnover") & away, "Turnover TD" if offense else "Takeaway TD"),
        (F.col("is_turnover"), "Turnover" if offense else "Takeaway"),
        (stated("is_touchdown"), "Touchdown" if offense else "TD allowed"),
        (F.col("play_kind") == "sack", "Sack"),
        ((F.col("play_kind") == "pass") & F.col("is_complete").eqNullSafe(F.lit(False)), "Incomplete"),
        (stated("first_down_gained"), "First down" if offense else "First down allowed"),
    ]
    if offense:
        return first_true([*branches, (yards > 0, "Gain"), (yards == 0, "No gain"), (yards < 0, "Loss")], "Unclassified")
    return first_true([*branches, (yards.isNull(), "Unclassified"), (yards <= 0, "Stop")], "Gain allowed")


def score_state(diff: Column) -> Column:
    """An unknown difference falls to the last label."""
    return F.when(diff > 0, "Leading").when(diff == 0, "Tied").otherwise("Trailing")


def site(home: Column) -> Column:
    """Unknown sides stay unknown: they are no away games."""
    return F.when(F.col("neutral_site"), "Neutral").when(home.isNull(), None).when(home, "Home").otherwise("Away")


def clock_label(seconds: str) -> Column:
    s = F.col(seconds)
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(two(F.floor(s / 60)), F.lit(":"), two(s % 60))


def kick_lens(wide: DataFrame, athletes: DataFrame | None = None) -> DataFrame:
    own_snap = lambda c: F.when(~F.col("play_uid").endswith(":pat"), F.col(c))  # noqa: E731  a derived conversion borrows the scoring play's situation
    kick_yds = F.coalesce("fg_distance_yds", "punt_gross_yds", "kickoff_yds")
    outcome = kick_outcome()
    return wide.select(
        "play_uid", "game_id", "season", "week", "season_type", "play_kind", outcome.alias("outcome"),
        F.col("kicker_athlete_id").alias("player_id"), F.coalesce("kicker_known_name", "kicker_name").alias("player"),
        F.coalesce(F.substring("kicker_name", 1, 1).isin("(", "#"), F.lit(False)).alias("player_name_unparsed"),
        F.col("kicking_team_id").alias("team_id"), F.col("kicking_team").alias("team"), F.col("kicking_conference").alias("conference"),
        F.col("receiving_team_id").alias("opp_id"), F.col("receiving_team").alias("opponent"), site(F.col("is_home_kicking")).alias("site"),
        "fg_distance_yds", "punt_gross_yds", "punt_net_yds", "kickoff_yds", "return_yds", kick_yds.alias("kick_yds"),
        (F.floor(kick_yds / 5) * 5).cast("int").alias("kick_bucket"), "returned_for_td", "onside", "converted", "two_point_type",
        F.col("period").alias("qtr"), clock_label("clock_secs_period").alias("clock"), own_snap("down").alias("down"),
        F.col("score_diff_kicking").alias("score_diff"), score_state(F.col("score_diff_kicking")).alias("score_state"), "is_clutch",
        F.to_date("kickoff_utc").alias("game_date"), "surface", "venue_indoor", "neutral_site", "conference_game", "both_top_division",
    ).withColumn("outcome_unknown", F.col("outcome") == "Unknown")


def scrimmage_lens(wide: DataFrame, side: str, limit: int = YARD_LIMIT) -> DataFrame:
    """side is 'offense' or 'defense': whose teams, signs and outcome words the rows use."""
    offense = side == "offense"
    own, other = ("offense", "defense") if offense else ("defense", "offense")
    sign = (lambda c: c) if offense else (lambda c: -c)
    yards = possible_yards(limit)
    diff = sign(F.col("score_diff_offense"))
    home = F.col("is_home_offense") if offense else ~F.col("is_home_offense")
    return wide.select(
        "play_uid", "game_id", "season", "week", "season_type", "play_kind", yards.alias("yards"),
        F.coalesce(F.abs("yards_gained") > limit, F.lit(False)).alias("yards_impossible"), "first_down_gained", "is_complete", "is_touchdown", "is_turnover",
        sign(F.col("points_scored")).alias("points_scored"), scrimmage_outcome(side, yards).alias("outcome"),
        (F.coalesce("passer_athlete_id", "rusher_athlete_id") if offense else F.col("tackler_athlete_id")).alias("player_id"),
        F.col(f"{own}_team_id").alias("team_id"), F.col(f"{own}_team").alias("team"), F.col(f"{own}_conference").alias("conference"), F.col(f"{other}_team_id").alias("opp_id"),
        site(home).alias("site"), F.col("period").alias("qtr"), "down", F.col("distance").alias("dist_to_go"), "distance_bucket", "field_zone",
        diff.alias("score_diff"), score_state(diff).alias("score_state"), "is_clutch", "venue_indoor", "neutral_site", "conference_game", "both_top_division",
        "passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id", "tackler_athlete_id",
    ).withColumn("outcome_unknown", F.col("outcome") == "Unclassified").withColumn("yards_bucket", (F.floor(F.col("yards") / 5.0) * 5).cast("int"))
