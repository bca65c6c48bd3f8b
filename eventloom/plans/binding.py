"""Play-shaped tables over the given star schema.

No sports feed exists here, so games, plays, people and dimensions are derived from the given
tables: an order is a game, a line item a play, a nation a team, a part a venue, a supplier an
athlete.  Every expression below is valid in Spark SQL and in DuckDB, so the oracle starts from the
same rows; what the library computes from them is written once as DataFrame code and once, apart
from it, as the oracle's SQL.

Flags are tri-state as in real feeds: R is true, A false, N not stated.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import events, lenses, wide

SEASONS = (1995, 2001)
CONFERENCE = "(team + (season % 3) * (team % 2)) % 5"


def conference(team: str, season: str) -> str:
    """A team's conference changes with the season for half of the teams."""
    return CONFERENCE.replace("team", team).replace("season", season)


HOME, AWAY = "(o_custkey % 25)", "((o_custkey + 1 + o_orderkey % 24) % 25)"
GAME = {
    "game_id": "o_orderkey",
    "season": "cast(year(o_orderdate) as int)",
    "day": "cast(dayofyear(o_orderdate) as int)",
    "season_type": "CASE WHEN month(o_orderdate) = 12 THEN 'postseason' ELSE 'regular' END",
    "kickoff_utc": "o_orderdate",
    "home_team_id": HOME,
    "away_team_id": AWAY,
    "venue_id": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE cast(floor((o_custkey * 4 + o_orderkey % 4) / 3.0) as bigint) END",
    "attendance": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey * 37 % 90000 END",
    "neutral_site": "o_orderkey % 17 = 0",
    "conference_game": f"{conference(HOME, 'cast(year(o_orderdate) as int)')} = {conference(AWAY, 'cast(year(o_orderdate) as int)')}",
}
TEAM = {"team_id": "cast(n_nationkey as bigint)", "display_name": "n_name", "founded_region": "n_regionkey"}
VENUE = {
    "venue_id": "p_partkey", "venue_name": "p_name", "city": "p_brand", "state": "p_type",
    "surface": "CASE p_size % 3 WHEN 0 THEN 'grass' WHEN 1 THEN 'turf' END",
    "indoor": "CASE WHEN p_size % 4 = 0 THEN true WHEN p_size % 4 = 1 THEN NULL ELSE false END",
}
ATHLETE = {
    "athlete_id": "s_suppkey", "known_name": "s_name",
    "position": "CASE s_suppkey % 5 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'LB' ELSE 'K' END",
    "name_confidence": "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE cast(s_suppkey % 101 as double) / 100 END",
    "primary_team_id": "cast(s_nationkey as bigint)",
}
#: Of a line item joined with its order's game columns.
PLAY = {
    "base_uid": "concat('t:', cast(l_orderkey as varchar(20)), ':', cast(l_linenumber as varchar(20)))",
    "game_id": "game_id", "season": "season", "week": "week", "season_type": "season_type", "seq": "l_linenumber",
    "fact": "CASE WHEN l_linestatus = 'O' THEN 'kicks' ELSE 'scrimmage' END",
    "period": "cast(1 + l_suppkey % 5 as int)",
    "clock_secs_period": "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE cast((l_partkey * 31 + l_suppkey * 7) % 901 as int) END",
    "down": "CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE cast(1 + l_linenumber % 4 as int) END",
    "distance": "cast(1 + l_suppkey % 15 as int)",
    "yards_to_goal": "cast(l_partkey % 100 as int)",
    "home_team_id": "home_team_id", "away_team_id": "away_team_id", "venue_id": "venue_id",
    "is_home": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_suppkey % 2 = 0 END",
    "own_team_id": "CASE WHEN l_suppkey % 2 = 0 THEN home_team_id ELSE away_team_id END",
    "other_team_id": "CASE WHEN l_suppkey % 2 = 0 THEN away_team_id ELSE home_team_id END",
    "score_diff": "CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE cast(l_partkey % 43 - 21 as int) END",
    "kickoff_utc": "kickoff_utc", "attendance": "attendance", "neutral_site": "neutral_site", "conference_game": "conference_game",
    "pk": "l_partkey", "sk": "l_suppkey", "qty": "cast(l_quantity as int)",
    "flag": "CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END",
    "tail": "concat(cast(l_extendedprice as varchar(40)), '|', cast(l_discount + 0.0 as varchar(40)), '|', cast(l_tax as varchar(40)))",
}
KICK_KIND = "CASE pk % 8 WHEN 0 THEN 'kickoff' WHEN 1 THEN 'kickoff' WHEN 2 THEN 'punt' WHEN 3 THEN 'punt' WHEN 4 THEN 'field_goal' WHEN 5 THEN 'field_goal' WHEN 6 THEN 'pat' ELSE CASE WHEN sk % 3 < 2 THEN 'two_point' ELSE 'defensive_conversion' END END"
KICK = {
    **{c: c for c in ("play_uid", "game_id", "season", "week", "season_type", "seq", "play_kind", "period", "clock_secs_period", "down", "distance", "yards_to_goal")},
    "kicking_team_id": "own_team_id", "receiving_team_id": "other_team_id", "is_home_kicking": "is_home", "score_diff_kicking": "score_diff",
    "fg_distance_yds": "CASE WHEN play_kind = 'field_goal' THEN cast(17 + sk % 46 as int) END",
    "fg_made": "CASE WHEN play_kind = 'field_goal' THEN flag END",
    "punt_gross_yds": "CASE WHEN play_kind = 'punt' THEN cast(25 + qty as int) END",
    "punt_net_yds": "CASE WHEN play_kind = 'punt' AND flag IS NOT NULL THEN cast(25 + qty - CASE WHEN flag THEN sk % 20 ELSE 0 END as int) END",
    "kickoff_yds": "CASE WHEN play_kind = 'kickoff' THEN cast(40 + pk % 31 as int) END",
    "returned": "CASE WHEN play_kind IN ('kickoff', 'punt') THEN flag END",
    "return_yds": "CASE WHEN play_kind IN ('kickoff', 'punt') AND flag THEN cast(sk % 20 as int) END",
    "touchback": "CASE WHEN play_kind IN ('kickoff', 'punt') AND flag IS NOT NULL THEN NOT flag AND sk % 4 = 0 END",
    "fair_catch": "CASE WHEN play_kind IN ('kickoff', 'punt') AND flag IS NOT NULL THEN NOT flag AND sk % 4 = 1 END",
    "out_of_bounds": "CASE WHEN play_kind IN ('kickoff', 'punt') AND flag IS NOT NULL THEN NOT flag AND sk % 4 = 2 END",
    "downed": "CASE WHEN play_kind IN ('kickoff', 'punt') AND flag IS NOT NULL THEN NOT flag AND sk % 4 = 3 AND pk % 3 > 0 END",
    "onside": "play_kind = 'kickoff' AND sk % 11 = 0",
    "kick_blocked": "CASE WHEN pk % 47 = 0 THEN NULL ELSE pk % 23 = 0 END",
    "returned_for_td": "coalesce(play_kind IN ('kickoff', 'punt') AND flag, false) AND sk % 17 = 0",
    "converted": "CASE WHEN play_kind IN ('pat', 'two_point', 'defensive_conversion') THEN flag END",
    "two_point_type": "CASE WHEN play_kind = 'two_point' THEN CASE pk % 3 WHEN 0 THEN 'pass' WHEN 1 THEN 'rush' END END",
    "kicker_athlete_id": "CASE WHEN pk % 19 = 0 THEN NULL ELSE sk END",
    "returner_athlete_id": "CASE WHEN flag THEN pk % 97 END",
    "tackler_athlete_id": "CASE WHEN flag THEN (pk * 7 + sk) % 100 END",
    "kicker_name": "CASE WHEN pk % 67 = 0 THEN '(Fake punt) X.Y' WHEN pk % 19 = 0 THEN NULL ELSE concat('P.', cast(sk as varchar(20))) END",
    "parse_confidence": "CASE WHEN pk % 71 = 0 THEN NULL WHEN pk % 5 = 0 THEN 'partial' WHEN pk % 33 = 0 THEN 'ambiguous' ELSE 'exact' END",
    "venue_id": "venue_id", "kickoff_utc": "kickoff_utc", "attendance": "attendance", "neutral_site": "neutral_site", "conference_game": "conference_game",
}
SCRIM_KIND = "CASE WHEN pk % 10 < 3 THEN 'rush' WHEN pk % 10 < 7 THEN 'pass' WHEN pk % 10 = 7 THEN 'sack' WHEN pk % 10 = 8 THEN 'penalty' ELSE 'other' END"
SCRIM = {
    **{c: c for c in ("play_uid", "game_id", "season", "week", "season_type", "seq", "play_kind", "period", "clock_secs_period", "down", "distance", "yards_to_goal")},
    "offense_team_id": "own_team_id", "defense_team_id": "other_team_id", "is_home_offense": "is_home", "score_diff_offense": "score_diff",
    "drive_id": "concat(cast(game_id as varchar(20)), '-', CASE WHEN seq < 3 THEN '1' WHEN seq < 5 THEN '2' ELSE '3' END)",
    "drive_number": "CASE WHEN seq < 3 THEN 1 WHEN seq < 5 THEN 2 ELSE 3 END",
    "yards_gained": "CASE WHEN pk % 53 = 0 THEN NULL WHEN pk % 97 = 0 THEN 180 ELSE cast(qty - 10 as int) END",
    "first_down_gained": "CASE WHEN pk % 59 = 0 THEN NULL ELSE qty - 10 >= distance END",
    "is_complete": "CASE WHEN play_kind = 'pass' THEN flag END",
    "is_touchdown": "CASE WHEN pk % 83 = 0 THEN NULL ELSE sk % 13 = 0 END",
    "is_turnover": "pk % 11 = 0",
    "is_penalty": "play_kind = 'penalty'",
    "points_scored": "CASE WHEN sk % 13 = 0 AND pk % 83 > 0 THEN CASE WHEN pk % 11 = 0 THEN -6 ELSE 6 END WHEN pk % 89 = 0 THEN NULL ELSE 0 END",
    "passer_athlete_id": "CASE WHEN play_kind IN ('pass', 'sack') AND pk % 19 > 0 THEN sk END",
    "rusher_athlete_id": "CASE WHEN play_kind = 'rush' AND pk % 19 > 0 THEN sk END",
    "receiver_athlete_id": "CASE WHEN play_kind = 'pass' THEN (pk * 3 + sk) % 100 END",
    "tackler_athlete_id": "CASE WHEN flag THEN (pk * 7 + sk) % 100 END",
    "assist_athlete_id": "CASE WHEN flag AND pk % 3 = 0 THEN (pk * 5 + sk) % 100 END",
    "venue_id": "venue_id", "kickoff_utc": "kickoff_utc", "attendance": "attendance", "neutral_site": "neutral_site", "conference_game": "conference_game",
}
#: The roles of the scrimmage fact and the columns that hold them.
ROLES = (("passer", "passer_athlete_id"), ("rusher", "rusher_athlete_id"), ("receiver", "receiver_athlete_id"), ("tackler", "tackler_athlete_id"), ("assistedBy", "assist_athlete_id"))
#: A total order over the rows of one base uid.
UID_ORDER = ("pk", "sk", "qty", "flag", "tail")
#: Plays dealt to one task, or nearly: a larger table makes more tasks, and larger ones only when there are MOST_TASKS.
TASK_ROWS = 200_000
#: Tasks that plays are dealt to at most, unless there are more cores: Spark writes a shuffle to no more than these
#: (spark.shuffle.sort.bypassMergeThreshold) straight to files, while one to more holds all that a task has read.
MOST_TASKS = 200


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in columns.items()]


class Tables:
    """The play-shaped frames of one folder of tables; each is a plan, nothing is computed here but a count of rows."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def tasks(self) -> int | None:
        """How many tasks plays are dealt to, by the row counts in the files' footers; None: one would do, so Spark decides."""
        n = -(-self.raw("lineitem").count() // TASK_ROWS)
        return max(min(n, MOST_TASKS), self.spark.sparkContext.defaultParallelism) if n > 1 else None

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """df by keys, to as many tasks as there are plays for; AQE puts none of these together again."""
        return df.repartition(self.tasks, *keys) if self.tasks else df

    @cached_property
    def games(self) -> DataFrame:
        g = self.raw("orders").selectExpr(*_exprs(GAME))
        return g.withColumn("week", F.expr("cast((day - 1) div 7 + 1 as int)")).drop("day")

    @cached_property
    def teams(self) -> DataFrame:
        return self.raw("nation").selectExpr(*_exprs(TEAM))

    @cached_property
    def team_seasons(self) -> DataFrame:
        years = F.explode(F.sequence(F.lit(SEASONS[0]), F.lit(SEASONS[1])))
        return self.teams.withColumn("season", years).selectExpr(
            "team_id", "season", f"concat('Conf ', cast({conference('team_id', 'season')} as varchar(5))) AS conference_name", "CASE WHEN team_id % 3 = 0 THEN 'FCS' ELSE 'FBS' END AS ncaa_division"
        )

    @cached_property
    def venues(self) -> DataFrame:
        return self.raw("part").selectExpr(*_exprs(VENUE))

    @cached_property
    def athletes(self) -> DataFrame:
        return self.raw("supplier").selectExpr(*_exprs(ATHLETE))

    @cached_property
    def plays(self) -> DataFrame:
        """All plays of both facts, in the columns of PLAY, each with a unique play_uid; the plays of a game are in one task."""
        joined = self.dealt(self.raw("lineitem"), "l_orderkey").join(self.dealt(self.games, "game_id"), F.col("l_orderkey") == F.col("game_id"))
        return events.unique_uids(joined.selectExpr(*_exprs(PLAY)), "base_uid", UID_ORDER, "play_uid", within=("game_id",))

    @cached_property
    def kicks(self) -> DataFrame:
        return self.plays.where("fact = 'kicks'").withColumn("play_kind", F.expr(KICK_KIND)).selectExpr(*_exprs(KICK))

    @cached_property
    def scrimmage(self) -> DataFrame:
        return self.plays.where("fact = 'scrimmage'").withColumn("play_kind", F.expr(SCRIM_KIND)).selectExpr(*_exprs(SCRIM))

    @cached_property
    def both_facts(self) -> DataFrame:
        """The plays of both facts in one pass, each with the kind its fact gives it; columns of KICK and SCRIM can be taken from it."""
        return self.plays.withColumn("play_kind", F.expr(f"CASE fact WHEN 'kicks' THEN {KICK_KIND} ELSE {SCRIM_KIND} END"))

    @cached_property
    def play_wide(self) -> DataFrame:
        return wide.play_wide(self.kicks, self.venues, self.teams, self.team_seasons, self.athletes)

    @cached_property
    def scrimmage_wide(self) -> DataFrame:
        return wide.scrimmage_wide(self.scrimmage, self.venues, self.teams, self.team_seasons, self.athletes)

    @cached_property
    def st(self) -> DataFrame:
        return lenses.kick_lens(self.play_wide, self.athletes)

    @cached_property
    def off(self) -> DataFrame:
        return lenses.scrimmage_lens(self.scrimmage_wide, "offense")

    @cached_property
    def deff(self) -> DataFrame:
        return lenses.scrimmage_lens(self.scrimmage_wide, "defense")

    @cached_property
    def people(self) -> DataFrame:
        """The bridge play x role x athlete of the scrimmage fact."""
        return self.people_with()

    def people_with(self, *carry: str) -> DataFrame:
        """The bridge with columns of the play."""
        return events.bridge(self.scrimmage, "play_uid", ROLES, unique=True, carry=carry)

    @cached_property
    def drives(self) -> DataFrame:
        return events.drive_rollup(self.scrimmage)


#: The same tables as common table expressions of DuckDB.
_PLAYS = f"""
g0 AS (SELECT {_select(GAME)} FROM orders),
games AS (SELECT * EXCLUDE (day), CAST((day - 1) // 7 + 1 AS INTEGER) AS week FROM g0),
teams AS (SELECT {_select(TEAM)} FROM nation),
team_seasons AS (SELECT team_id, season, concat('Conf ', cast({conference('team_id', 'season')} as varchar(5))) AS conference_name, CASE WHEN team_id % 3 = 0 THEN 'FCS' ELSE 'FBS' END AS ncaa_division
                 FROM teams, (SELECT CAST(unnest(generate_series({SEASONS[0]}, {SEASONS[1]})) AS INTEGER) AS season)),
venues AS (SELECT {_select(VENUE)} FROM part),
athletes AS (SELECT {_select(ATHLETE)} FROM supplier),
pl AS (SELECT {_select(PLAY)} FROM lineitem JOIN games ON l_orderkey = game_id),
plays AS (SELECT * EXCLUDE (rn), CASE WHEN rn = 1 THEN base_uid ELSE base_uid || '#' || rn END AS play_uid
          FROM (SELECT *, row_number() OVER (PARTITION BY game_id, base_uid ORDER BY {', '.join(c + ' NULLS FIRST' for c in UID_ORDER)}) AS rn FROM pl)),
kicks AS (SELECT {_select(KICK)} FROM (SELECT *, {KICK_KIND} AS play_kind FROM plays WHERE fact = 'kicks')),
scrim AS (SELECT {_select(SCRIM)} FROM (SELECT *, {SCRIM_KIND} AS play_kind FROM plays WHERE fact = 'scrimmage'))"""

_WIDE = """
play_wide AS (SELECT k.*, a.known_name AS kicker_known_name, a.name_confidence AS kicker_name_confidence, a.position AS kicker_position,
    v.venue_name, v.city AS venue_city, v.state AS venue_state, v.surface, v.indoor AS venue_indoor,
    kt.display_name AS kicking_team, rt.display_name AS receiving_team, ks.conference_name AS kicking_conference, rs.conference_name AS receiving_conference,
    ks.ncaa_division AS kicking_division, rs.ncaa_division AS receiving_division,
    if(period IS NULL OR clock_secs_period IS NULL, NULL, if(period > 4, 0, (4 - period) * 900 + clock_secs_period)) AS game_secs_remaining,
    period >= 4 AND abs(score_diff_kicking) <= 8 AND (period > 4 OR clock_secs_period <= 300) AS is_clutch,
    if(fg_distance_yds < 20, 15, if(fg_distance_yds >= 60, 60, fg_distance_yds // 5 * 5)) AS fg_dist_bucket,
    CAST(month(kickoff_utc) AS INTEGER) AS game_month, ks.ncaa_division = 'FBS' AND rs.ncaa_division = 'FBS' AS both_top_division
  FROM kicks k LEFT JOIN venues v USING (venue_id) LEFT JOIN teams kt ON kt.team_id = kicking_team_id LEFT JOIN teams rt ON rt.team_id = receiving_team_id
  LEFT JOIN team_seasons ks ON ks.team_id = kicking_team_id AND ks.season = k.season LEFT JOIN team_seasons rs ON rs.team_id = receiving_team_id AND rs.season = k.season
  LEFT JOIN athletes a ON a.athlete_id = kicker_athlete_id),
scrimmage_wide AS (SELECT s.*, pa.known_name AS passer_name, ra.known_name AS rusher_name, wa.known_name AS receiver_name, ta.known_name AS tackler_name,
    v.venue_name, v.surface, v.indoor AS venue_indoor, ot.display_name AS offense_team, dt.display_name AS defense_team,
    os.conference_name AS offense_conference, ds.conference_name AS defense_conference, os.ncaa_division AS offense_division, ds.ncaa_division AS defense_division,
    if(period IS NULL OR clock_secs_period IS NULL, NULL, if(period > 4, 0, (4 - period) * 900 + clock_secs_period)) AS game_secs_remaining,
    period >= 4 AND abs(score_diff_offense) <= 8 AND (period > 4 OR clock_secs_period <= 300) AS is_clutch,
    if(down IS NULL OR distance IS NULL, NULL, if(distance <= 3, 'short', if(distance <= 7, 'medium', 'long'))) AS distance_bucket,
    if(yards_to_goal IS NULL, NULL, if(yards_to_goal <= 20, 'red zone', if(yards_to_goal <= 50, 'opponent half', 'own half'))) AS field_zone,
    CAST(month(kickoff_utc) AS INTEGER) AS game_month, os.ncaa_division = 'FBS' AND ds.ncaa_division = 'FBS' AS both_top_division
  FROM scrim s LEFT JOIN venues v USING (venue_id) LEFT JOIN teams ot ON ot.team_id = offense_team_id LEFT JOIN teams dt ON dt.team_id = defense_team_id
  LEFT JOIN team_seasons os ON os.team_id = offense_team_id AND os.season = s.season LEFT JOIN team_seasons ds ON ds.team_id = defense_team_id AND ds.season = s.season
  LEFT JOIN athletes pa ON pa.athlete_id = passer_athlete_id LEFT JOIN athletes ra ON ra.athlete_id = rusher_athlete_id
  LEFT JOIN athletes wa ON wa.athlete_id = receiver_athlete_id LEFT JOIN athletes ta ON ta.athlete_id = tackler_athlete_id)"""

_LENS = """
st AS (SELECT *, outcome = 'Unknown' AS outcome_unknown FROM (SELECT play_uid, game_id, season, week, season_type, play_kind,
    if(play_kind IN ('pat', 'two_point', 'defensive_conversion'), if(converted IS NULL, 'Unknown', if(converted, 'Converted', if(kick_blocked IS TRUE, 'Blocked', 'Failed'))),
      if(play_kind = 'field_goal', if(fg_made IS NULL, 'Negated', if(fg_made, 'Made', if(kick_blocked IS TRUE, 'Blocked', 'Missed'))),
        CASE WHEN onside IS TRUE THEN 'Onside' WHEN returned IS NULL THEN 'Unknown' WHEN kick_blocked IS TRUE THEN 'Blocked' WHEN touchback IS TRUE THEN 'Touchback' WHEN fair_catch IS TRUE THEN 'Fair catch'
             WHEN out_of_bounds IS TRUE THEN 'Out of bounds' WHEN downed IS TRUE THEN 'Downed' WHEN returned THEN 'Returned' ELSE 'Unknown' END)) AS outcome,
    kicker_athlete_id AS player_id, coalesce(kicker_known_name, kicker_name) AS player, coalesce(kicker_name[1] IN ('(', '#'), false) AS player_name_unparsed,
    kicking_team_id AS team_id, kicking_team AS team, kicking_conference AS conference, receiving_team_id AS opp_id, receiving_team AS opponent,
    if(neutral_site, 'Neutral', if(is_home_kicking IS NULL, NULL, if(is_home_kicking, 'Home', 'Away'))) AS site,
    fg_distance_yds, punt_gross_yds, punt_net_yds, kickoff_yds, return_yds, coalesce(fg_distance_yds, punt_gross_yds, kickoff_yds) AS kick_yds,
    coalesce(fg_distance_yds, punt_gross_yds, kickoff_yds) // 5 * 5 AS kick_bucket, returned_for_td, onside, converted, two_point_type,
    period AS qtr, lpad(CAST(clock_secs_period // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(clock_secs_period % 60 AS VARCHAR), 2, '0') AS clock,
    if(play_uid LIKE '%:pat', NULL, down) AS down, score_diff_kicking AS score_diff,
    CASE WHEN score_diff_kicking > 0 THEN 'Leading' WHEN score_diff_kicking = 0 THEN 'Tied' ELSE 'Trailing' END AS score_state,
    is_clutch, CAST(kickoff_utc AS DATE) AS game_date, surface, venue_indoor, neutral_site, conference_game, both_top_division FROM play_wide)),
scrim_lens AS (SELECT *, if(abs(yards_gained) > 110, NULL, yards_gained) AS yards, coalesce(abs(yards_gained) > 110, false) AS yards_impossible FROM scrimmage_wide),
off AS (SELECT *, outcome = 'Unclassified' AS outcome_unknown, CAST(floor(yards / 5.0) * 5 AS INTEGER) AS yards_bucket FROM (SELECT play_uid, game_id, season, week, season_type, play_kind, yards, yards_impossible, first_down_gained, is_complete, is_touchdown, is_turnover, points_scored,
    CASE WHEN is_penalty THEN 'Penalty' WHEN is_turnover AND coalesce(points_scored, 0) < 0 THEN 'Turnover TD' WHEN is_turnover THEN 'Turnover' WHEN is_touchdown IS TRUE THEN 'Touchdown' WHEN play_kind = 'sack' THEN 'Sack'
         WHEN play_kind = 'pass' AND is_complete IS FALSE THEN 'Incomplete' WHEN first_down_gained IS TRUE THEN 'First down' WHEN yards > 0 THEN 'Gain' WHEN yards = 0 THEN 'No gain' WHEN yards < 0 THEN 'Loss' ELSE 'Unclassified' END AS outcome,
    coalesce(passer_athlete_id, rusher_athlete_id) AS player_id, offense_team_id AS team_id, offense_team AS team, offense_conference AS conference, defense_team_id AS opp_id,
    if(neutral_site, 'Neutral', if(is_home_offense IS NULL, NULL, if(is_home_offense, 'Home', 'Away'))) AS site, period AS qtr, down, distance AS dist_to_go, distance_bucket, field_zone, score_diff_offense AS score_diff,
    CASE WHEN score_diff_offense > 0 THEN 'Leading' WHEN score_diff_offense = 0 THEN 'Tied' ELSE 'Trailing' END AS score_state, is_clutch, venue_indoor, neutral_site, conference_game, both_top_division,
    passer_athlete_id, rusher_athlete_id, receiver_athlete_id, tackler_athlete_id FROM scrim_lens)),
deff AS (SELECT *, outcome = 'Unclassified' AS outcome_unknown, CAST(floor(yards / 5.0) * 5 AS INTEGER) AS yards_bucket FROM (SELECT play_uid, game_id, season, week, season_type, play_kind, yards, yards_impossible, first_down_gained, is_complete, is_touchdown, is_turnover, -points_scored AS points_scored,
    CASE WHEN is_penalty THEN 'Penalty' WHEN is_turnover AND coalesce(points_scored, 0) < 0 THEN 'Takeaway TD' WHEN is_turnover THEN 'Takeaway' WHEN is_touchdown IS TRUE THEN 'TD allowed' WHEN play_kind = 'sack' THEN 'Sack'
         WHEN play_kind = 'pass' AND is_complete IS FALSE THEN 'Incomplete' WHEN first_down_gained IS TRUE THEN 'First down allowed' WHEN yards IS NULL THEN 'Unclassified' WHEN yards <= 0 THEN 'Stop' ELSE 'Gain allowed' END AS outcome,
    tackler_athlete_id AS player_id, defense_team_id AS team_id, defense_team AS team, defense_conference AS conference, offense_team_id AS opp_id,
    if(neutral_site, 'Neutral', if(is_home_offense IS NULL, NULL, if(is_home_offense, 'Away', 'Home'))) AS site, period AS qtr, down, distance AS dist_to_go, distance_bucket, field_zone, -score_diff_offense AS score_diff,
    CASE WHEN -score_diff_offense > 0 THEN 'Leading' WHEN -score_diff_offense = 0 THEN 'Tied' ELSE 'Trailing' END AS score_state, is_clutch, venue_indoor, neutral_site, conference_game, both_top_division,
    passer_athlete_id, rusher_athlete_id, receiver_athlete_id, tackler_athlete_id FROM scrim_lens))"""

_PEOPLE = """
people AS (SELECT play_uid, role, athlete_id, CAST(min(o) AS INTEGER) AS ordinal FROM (
    SELECT play_uid, 'passer' AS role, passer_athlete_id AS athlete_id, 0 AS o FROM scrim UNION ALL SELECT play_uid, 'rusher', rusher_athlete_id, 1 FROM scrim
    UNION ALL SELECT play_uid, 'receiver', receiver_athlete_id, 2 FROM scrim UNION ALL SELECT play_uid, 'tackler', tackler_athlete_id, 3 FROM scrim
    UNION ALL SELECT play_uid, 'assistedBy', assist_athlete_id, 4 FROM scrim) WHERE athlete_id IS NOT NULL GROUP BY ALL),
drives AS (SELECT game_id, drive_id, drive_number, min(season) AS season, arg_min(offense_team_id, (seq, play_uid)) AS offense_team_id,
    arg_min(yards_to_goal, (seq, play_uid)) AS start_yards_to_goal, arg_max(yards_to_goal, (seq, play_uid)) AS end_yards_to_goal,
    count(*) AS plays, CAST(coalesce(sum(yards_gained) FILTER (WHERE NOT is_turnover AND abs(yards_gained) <= 110), 0) AS BIGINT) AS yards,
    coalesce(bool_or(points_scored > 0), false) AS is_score, CASE WHEN coalesce(bool_or(points_scored > 0), false) THEN 'TD' WHEN bool_or(is_turnover) THEN 'TURNOVER' ELSE 'PUNT' END AS result
  FROM scrim GROUP BY game_id, drive_id, drive_number)"""


def sql(body: str) -> str:
    """The oracle's SQL: the play-shaped tables, then body.  (DuckDB computes only the tables that body names.)"""
    return f"WITH {_PLAYS}, {_WIDE}, {_LENS}, {_PEOPLE}\n{body}"
