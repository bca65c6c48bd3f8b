"""Typed tools: discovery, games, players, leaderboards, splits, trends, teams and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import events
from eventloom.operators import filters as fl
from eventloom.operators import metrics as m
from eventloom.plans.binding import ROLES, Tables
from eventloom.plans.registry import query

GAME_ID = 1201
PLAYER = 7


@query("q01_data_coverage", """
SELECT season, CAST(count(DISTINCT game_id) AS BIGINT) AS games, count(*) AS plays, CAST(count(*) FILTER (WHERE returned IS NULL AND play_kind IN ('kickoff', 'punt')) AS BIGINT) AS unstated,
       max(week) FILTER (WHERE season_type = 'regular') AS last_regular_week, max(kickoff_utc) AS last_kickoff FROM kicks GROUP BY season""")
def data_coverage(t: Tables) -> DataFrame:
    return t.kicks.groupBy("season").agg(
        F.countDistinct("game_id").alias("games"), m.n().alias("plays"), m.n(F.col("returned").isNull() & F.col("play_kind").isin("kickoff", "punt")).alias("unstated"),
        m.top("week", F.col("season_type") == "regular").alias("last_regular_week"), F.max("kickoff_utc").alias("last_kickoff"),
    )


@query("q02_find_team", """
SELECT t.team_id, display_name, s.conference_name, s.season FROM teams t LEFT JOIN team_seasons s ON s.team_id = t.team_id AND s.season = (SELECT max(season) FROM team_seasons x WHERE x.team_id = t.team_id)
WHERE display_name ILIKE '%nation_1%' ORDER BY CASE WHEN lower(display_name) = 'nation_1' THEN 0 WHEN lower(display_name) LIKE 'nation\\_1%' ESCAPE '\\' THEN 1 ELSE 2 END, length(display_name), display_name, t.team_id LIMIT 8""")
def find_team(t: Tables, text: str = "nation_1", limit: int = 8) -> DataFrame:
    """Teams by name, exact before prefix before rest, with the conference of their latest season."""
    latest = t.team_seasons.groupBy("team_id").agg(F.max(F.struct("season", "conference_name")).alias("last")).select("team_id", "last.*")
    found = t.teams.select("team_id", "display_name").where(fl.matching("display_name", text)).join(latest, "team_id", "left")
    rank = F.when(fl.matching("display_name", text, "exact"), 0).when(fl.matching("display_name", text, "prefix"), 1).otherwise(2)
    return found.orderBy(rank, F.length("display_name"), "display_name", "team_id").limit(limit)


@query("q03_find_player", """
SELECT athlete_id, known_name, position, primary_team_id, name_confidence FROM athletes WHERE known_name ILIKE '%0000001%' ORDER BY name_confidence DESC NULLS LAST, athlete_id LIMIT 10""")
def find_player(t: Tables) -> DataFrame:
    return t.athletes.where(fl.matching("known_name", "0000001")).orderBy(F.desc_nulls_last("name_confidence"), "athlete_id").limit(10)


@query("q04_find_venue", "SELECT v.venue_id, venue_name, surface, indoor, (SELECT count(*) FROM games g WHERE g.venue_id = v.venue_id) AS games FROM venues v WHERE venue_name ILIKE '%ring%'")
def find_venue(t: Tables) -> DataFrame:
    counts = t.games.groupBy("venue_id").agg(m.n().alias("games"))
    found = t.venues.where(fl.matching("venue_name", "ring")).join(counts, "venue_id", "left")
    return found.select("venue_id", "venue_name", "surface", "indoor", F.coalesce("games", F.lit(0)).alias("games"))


@query("q05_list_conferences", "SELECT conference_name, count(DISTINCT team_id) AS teams, min(season) AS first_season, max(season) AS last_season FROM team_seasons WHERE season = 1997 GROUP BY 1")
def list_conferences(t: Tables, season: int | None = 1997) -> DataFrame:
    return fl.optional(t.team_seasons, season=season).groupBy("conference_name").agg(F.countDistinct("team_id").alias("teams"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))


@query("q06_list_games", """
SELECT game_id, season, week, h.display_name AS home_team, a.display_name AS away_team, v.venue_name, attendance FROM games g LEFT JOIN teams h ON h.team_id = home_team_id LEFT JOIN teams a ON a.team_id = away_team_id
LEFT JOIN venues v ON v.venue_id = g.venue_id WHERE season = 1998 AND (home_team_id = 3 OR away_team_id = 3) ORDER BY kickoff_utc DESC NULLS LAST, game_id LIMIT 50""")
def list_games(t: Tables, season: int | None = 1998, team_id: int | None = 3, limit: int = 50) -> DataFrame:
    found = fl.optional(t.games, season=season)
    found = found if team_id is None else found.where(fl.either(team_id, "home_team_id", "away_team_id"))
    page = found.orderBy(F.desc_nulls_last("kickoff_utc"), "game_id").limit(fl.clamped(limit))  # the top rows first: names are joined to few
    named = _named(page, t, "home", "away").join(t.venues.select("venue_id", "venue_name"), "venue_id", "left")
    return named.select("game_id", "season", "week", "home_team", "away_team", "venue_name", "attendance")


def _named(df: DataFrame, t: Tables, *sides: str) -> DataFrame:
    for s in sides:
        df = df.join(t.teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("display_name").alias(f"{s}_team")), f"{s}_team_id", "left")
    return df


@query("q07_game_header", f"""
SELECT game_id, g.season, h.display_name AS home_team, a.display_name AS away_team, hs.conference_name AS home_conference, s.conference_name AS away_conference, neutral_site, conference_game FROM games g
LEFT JOIN teams h ON h.team_id = home_team_id LEFT JOIN teams a ON a.team_id = away_team_id LEFT JOIN team_seasons hs ON hs.team_id = home_team_id AND hs.season = g.season LEFT JOIN team_seasons s ON s.team_id = away_team_id AND s.season = g.season WHERE game_id = {GAME_ID}""")
def game_header(t: Tables, game_id: int = GAME_ID) -> DataFrame:
    g = _named(t.games.where(F.col("game_id") == game_id), t, "home", "away")
    for s in ("home", "away"):
        g = g.join(t.team_seasons.select(F.col("team_id").alias(f"{s}_team_id"), "season", F.col("conference_name").alias(f"{s}_conference")), [f"{s}_team_id", "season"], "left")
    return g.select("game_id", "season", "home_team", "away_team", "home_conference", "away_conference", "neutral_site", "conference_game")


def _points(t: Tables, conversions: bool) -> DataFrame:
    """(game_id, team_id, pts): points by who scored them; a negative play scores for the defense."""
    signed = t.scrimmage.where("points_scored <> 0")
    scrim = signed.select("game_id", F.when(F.col("points_scored") > 0, F.col("offense_team_id")).otherwise(F.col("defense_team_id")).alias("team_id"), F.abs("points_scored").alias("pts"))
    k = t.kicks
    value = F.when((F.col("play_kind") == "field_goal") & F.col("fg_made"), 3)
    if conversions:
        value = value.when((F.col("play_kind") == "pat") & F.col("converted"), 1).when((F.col("play_kind") == "two_point") & F.col("converted"), 2)
    kicked = k.select("game_id", F.col("kicking_team_id").alias("team_id"), value.otherwise(0).alias("pts"))
    back = k.where("returned_for_td").select("game_id", F.col("receiving_team_id").alias("team_id"), F.lit(6).alias("pts"))
    return scrim.unionByName(kicked).unionByName(back)


@query("q08_game_score", """
SELECT game_id, team_id, CAST(sum(pts) AS BIGINT) AS points FROM (
  SELECT game_id, offense_team_id AS team_id, points_scored AS pts FROM scrim WHERE points_scored > 0 UNION ALL SELECT game_id, defense_team_id, -points_scored FROM scrim WHERE points_scored < 0
  UNION ALL SELECT game_id, kicking_team_id, CASE WHEN play_kind = 'field_goal' AND fg_made THEN 3 WHEN play_kind = 'pat' AND converted THEN 1 WHEN play_kind = 'two_point' AND converted THEN 2 ELSE 0 END FROM kicks
  UNION ALL SELECT game_id, receiving_team_id, 6 FROM kicks WHERE returned_for_td) GROUP BY game_id, team_id""")
def game_score(t: Tables) -> DataFrame:
    """Points of both sides of every game, conversions counted as plays of their own."""
    return _points(t, True).groupBy("game_id", "team_id").agg(F.sum("pts").alias("points"))


@query("q08b_game_score_folded", """
SELECT game_id, team_id, CAST(sum(pts) AS BIGINT) AS points FROM (
  SELECT game_id, offense_team_id AS team_id, points_scored AS pts FROM scrim WHERE points_scored > 0 UNION ALL SELECT game_id, defense_team_id, -points_scored FROM scrim WHERE points_scored < 0
  UNION ALL SELECT game_id, kicking_team_id, CASE WHEN play_kind = 'field_goal' AND fg_made THEN 3 ELSE 0 END FROM kicks
  UNION ALL SELECT game_id, receiving_team_id, 6 FROM kicks WHERE returned_for_td) GROUP BY game_id, team_id""")
def game_score_folded(t: Tables) -> DataFrame:
    """The same where touchdowns already hold their conversion: conversions are not added again."""
    return _points(t, False).groupBy("game_id", "team_id").agg(F.sum("pts").alias("points"))


@query("q09_game_play_counts", "SELECT game_id, 'kicks' AS fact, play_kind, count(*) AS plays FROM kicks GROUP BY 1, 3 UNION ALL SELECT game_id, 'scrimmage', play_kind, count(*) FROM scrim GROUP BY 1, 3")
def game_play_counts(t: Tables) -> DataFrame:
    both = t.kicks.select("game_id", "play_kind", F.lit("kicks").alias("fact")).unionByName(t.scrimmage.select("game_id", "play_kind", F.lit("scrimmage").alias("fact")))
    return both.groupBy("game_id", "fact", "play_kind").agg(m.n().alias("plays"))


@query("q10_drive_chart", "SELECT d.game_id, drive_number, display_name AS offense, start_yards_to_goal, end_yards_to_goal, plays, yards, result FROM drives d LEFT JOIN teams ON team_id = offense_team_id")
def drive_chart(t: Tables) -> DataFrame:
    d = t.drives.join(t.teams, F.col("offense_team_id") == F.col("team_id"), "left")
    return d.select("game_id", "drive_number", F.col("display_name").alias("offense"), "start_yards_to_goal", "end_yards_to_goal", "plays", "yards", "result")


@query("q11_play_participants", "SELECT play_uid, role, ordinal, athlete_id, known_name, position FROM people LEFT JOIN athletes USING (athlete_id)")
def play_participants(t: Tables) -> DataFrame:
    found = t.people.join(t.athletes, "athlete_id", "left")
    return found.select("play_uid", "role", "ordinal", "athlete_id", "known_name", "position")


@query("q12_player_profile", f"SELECT athlete_id, known_name, position, name_confidence, display_name AS primary_team FROM athletes LEFT JOIN teams ON team_id = primary_team_id WHERE athlete_id = {PLAYER}")
def player_profile(t: Tables, athlete_id: int = PLAYER) -> DataFrame:
    a = t.athletes.where(F.col("athlete_id") == athlete_id).join(t.teams, F.col("primary_team_id") == F.col("team_id"), "left")
    return a.select("athlete_id", "known_name", "position", "name_confidence", F.col("display_name").alias("primary_team"))


@query("q13_player_kicking", f"""
SELECT season, count(*) FILTER (WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL) AS fg_att, count(*) FILTER (WHERE play_kind = 'field_goal' AND fg_made) AS fg_made,
  100.0 * avg(CAST(fg_made AS INTEGER)) FILTER (WHERE play_kind = 'field_goal') AS fg_pct, max(fg_distance_yds) FILTER (WHERE play_kind = 'field_goal' AND fg_made) AS longest_fg,
  count(*) FILTER (WHERE play_kind = 'pat' AND converted IS NOT NULL) AS pat_att, count(*) FILTER (WHERE play_kind = 'pat' AND converted) AS pat_made, count(*) FILTER (WHERE play_kind = 'punt') AS punts,
  avg(punt_gross_yds) FILTER (WHERE play_kind = 'punt') AS punt_gross_avg, avg(punt_net_yds) FILTER (WHERE play_kind = 'punt') AS punt_net_avg, count(*) FILTER (WHERE play_kind = 'kickoff') AS kickoffs,
  100.0 * avg(CAST(touchback AS INTEGER)) FILTER (WHERE play_kind = 'kickoff' AND returned IS NOT NULL) AS kickoff_tb_pct FROM kicks WHERE kicker_athlete_id = {PLAYER} GROUP BY season""")
def player_kicking(t: Tables, athlete_id: int = PLAYER) -> DataFrame:
    k, own = F.col("play_kind"), t.kicks.where(F.col("kicker_athlete_id") == athlete_id)
    made, tried = F.col("fg_made"), (k == "field_goal") & F.col("fg_made").isNotNull()
    return own.groupBy("season").agg(
        m.n(tried).alias("fg_att"), m.n((k == "field_goal") & made).alias("fg_made"), m.percent("fg_made", k == "field_goal").alias("fg_pct"), m.top("fg_distance_yds", (k == "field_goal") & made).alias("longest_fg"),
        m.n((k == "pat") & F.col("converted").isNotNull()).alias("pat_att"), m.n((k == "pat") & F.col("converted")).alias("pat_made"), m.n(k == "punt").alias("punts"),
        m.mean("punt_gross_yds", k == "punt").alias("punt_gross_avg"), m.mean("punt_net_yds", k == "punt").alias("punt_net_avg"), m.n(k == "kickoff").alias("kickoffs"),
        m.percent("touchback", (k == "kickoff") & F.col("returned").isNotNull()).alias("kickoff_tb_pct"),
    )


@query("q14_player_scrimmage", f"""
SELECT season, count(*) FILTER (WHERE rusher_athlete_id = {PLAYER} AND play_kind = 'rush') AS rush_att, CAST(sum(yards_gained) FILTER (WHERE rusher_athlete_id = {PLAYER} AND play_kind = 'rush' AND NOT is_turnover) AS BIGINT) AS rush_yds,
  count(*) FILTER (WHERE passer_athlete_id = {PLAYER} AND play_kind = 'pass') AS pass_att, count(*) FILTER (WHERE passer_athlete_id = {PLAYER} AND is_complete) AS pass_cmp, CAST(sum(yards_gained) FILTER (WHERE passer_athlete_id = {PLAYER} AND play_kind = 'pass' AND NOT is_turnover) AS BIGINT) AS pass_yds,
  count(*) FILTER (WHERE passer_athlete_id = {PLAYER} AND is_turnover) AS pass_int, count(*) FILTER (WHERE receiver_athlete_id = {PLAYER}) AS targets, count(*) FILTER (WHERE receiver_athlete_id = {PLAYER} AND is_complete) AS receptions,
  CAST(sum(yards_gained) FILTER (WHERE receiver_athlete_id = {PLAYER} AND is_complete AND NOT is_turnover) AS BIGINT) AS rec_yds, count(*) FILTER (WHERE tackler_athlete_id = {PLAYER}) AS tackles
FROM scrim WHERE {PLAYER} IN (passer_athlete_id, rusher_athlete_id, receiver_athlete_id, tackler_athlete_id) GROUP BY season""")
def player_scrimmage(t: Tables, athlete_id: int = PLAYER) -> DataFrame:
    """One player in four roles at once; turnover yards are the other side's and in no sum."""
    k, kept, done = F.col("play_kind"), ~F.col("is_turnover"), F.col("is_complete")
    is_ = lambda role: F.col(f"{role}_athlete_id") == athlete_id
    own = t.scrimmage.where(fl.either(athlete_id, "passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id", "tackler_athlete_id"))
    return own.groupBy("season").agg(
        m.n(is_("rusher") & (k == "rush")).alias("rush_att"), m.total("yards_gained", is_("rusher") & (k == "rush") & kept).alias("rush_yds"),
        m.n(is_("passer") & (k == "pass")).alias("pass_att"), m.n(is_("passer") & done).alias("pass_cmp"), m.total("yards_gained", is_("passer") & (k == "pass") & kept).alias("pass_yds"),
        m.n(is_("passer") & F.col("is_turnover")).alias("pass_int"), m.n(is_("receiver")).alias("targets"), m.n(is_("receiver") & done).alias("receptions"),
        m.total("yards_gained", is_("receiver") & done & kept).alias("rec_yds"), m.n(is_("tackler")).alias("tackles"),
    )


@query("q15_player_game_log", f"""
SELECT game_id, season, week, season_type, kickoff_utc, offense_team AS team, defense_team AS opponent, count(*) FILTER (WHERE rusher_athlete_id = {PLAYER}) AS rush_att, count(*) FILTER (WHERE passer_athlete_id = {PLAYER}) AS pass_att,
  count(*) FILTER (WHERE tackler_athlete_id = {PLAYER}) AS tackles, count(*) FILTER (WHERE is_touchdown AND {PLAYER} IN (rusher_athlete_id, receiver_athlete_id, passer_athlete_id)) AS touchdowns
FROM scrimmage_wide WHERE {PLAYER} IN (passer_athlete_id, rusher_athlete_id, receiver_athlete_id, tackler_athlete_id) GROUP BY ALL ORDER BY kickoff_utc DESC NULLS LAST, game_id, team, opponent LIMIT 40""")
def player_game_log(t: Tables, athlete_id: int = PLAYER, limit: int = 40) -> DataFrame:
    own = t.scrimmage_wide.where(fl.either(athlete_id, "passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id", "tackler_athlete_id"))
    keys = ["game_id", "season", "week", "season_type", "kickoff_utc", F.col("offense_team").alias("team"), F.col("defense_team").alias("opponent")]
    is_ = lambda role: F.col(f"{role}_athlete_id") == athlete_id
    log = own.groupBy(*keys).agg(m.n(is_("rusher")).alias("rush_att"), m.n(is_("passer")).alias("pass_att"), m.n(is_("tackler")).alias("tackles"), m.n(F.col("is_touchdown") & fl.either(athlete_id, "rusher_athlete_id", "receiver_athlete_id", "passer_athlete_id")).alias("touchdowns"))
    return log.orderBy(F.desc_nulls_last("kickoff_utc"), "game_id", "team", "opponent").limit(limit)


@query("q16_leaders_fg_pct", """
SELECT kicker_athlete_id AS athlete_id, known_name, a.position, max(kicking_team) AS team, count(*) AS attempts, count(*) FILTER (WHERE fg_made) AS made, 100.0 * avg(CAST(fg_made AS INTEGER)) AS fg_pct, max(fg_distance_yds) FILTER (WHERE fg_made) AS longest
FROM play_wide JOIN athletes a ON athlete_id = kicker_athlete_id WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL GROUP BY ALL HAVING count(*) >= 5 ORDER BY fg_pct DESC NULLS LAST, attempts DESC, athlete_id LIMIT 25""")
def leaders_fg_pct(t: Tables) -> DataFrame:
    """A negated kick is no miss: it is in neither number of the rate."""
    tried = t.play_wide.where((F.col("play_kind") == "field_goal") & F.col("fg_made").isNotNull())
    return m.leaders(tried, t.athletes, "kicker_athlete_id", {"team": F.max("kicking_team"), "attempts": m.n(), "made": m.n(F.col("fg_made")), "fg_pct": m.percent("fg_made"), "longest": m.top("fg_distance_yds", F.col("fg_made"))}, 5, "attempts", ("fg_pct", "attempts"), 25)


@query("q17_leaders_punt_gross", """
SELECT kicker_athlete_id AS athlete_id, known_name, a.position, count(*) AS attempts, avg(punt_gross_yds) AS punt_gross_avg, avg(punt_net_yds) AS punt_net_avg
FROM play_wide JOIN athletes a ON athlete_id = kicker_athlete_id WHERE play_kind = 'punt' AND punt_gross_yds IS NOT NULL GROUP BY ALL HAVING count(*) >= 5 ORDER BY punt_gross_avg DESC NULLS LAST, athlete_id LIMIT 25""")
def leaders_punt_gross(t: Tables) -> DataFrame:
    punts = t.play_wide.where((F.col("play_kind") == "punt") & F.col("punt_gross_yds").isNotNull())
    return m.leaders(punts, t.athletes, "kicker_athlete_id", {"attempts": m.n(), "punt_gross_avg": m.mean("punt_gross_yds"), "punt_net_avg": m.mean("punt_net_yds")}, 5, "attempts", ("punt_gross_avg",), 25)


@query("q18_leaders_rush_yards", """
SELECT rusher_athlete_id AS athlete_id, known_name, a.position, max(offense_team) AS team, count(*) AS attempts, CAST(sum(yards_gained) FILTER (WHERE NOT is_turnover) AS BIGINT) AS yards, avg(yards_gained) FILTER (WHERE NOT is_turnover) AS ypc, count(*) FILTER (WHERE is_touchdown) AS touchdowns
FROM scrimmage_wide JOIN athletes a ON athlete_id = rusher_athlete_id WHERE play_kind = 'rush' AND both_top_division GROUP BY ALL HAVING count(*) >= 3 ORDER BY yards DESC NULLS LAST, athlete_id LIMIT 25""")
def leaders_rush(t: Tables) -> DataFrame:
    rushes, kept = t.scrimmage_wide.where((F.col("play_kind") == "rush") & F.col("both_top_division")), ~F.col("is_turnover")
    return m.leaders(rushes, t.athletes, "rusher_athlete_id", {"team": F.max("offense_team"), "attempts": m.n(), "yards": m.total("yards_gained", kept), "ypc": m.mean("yards_gained", kept), "touchdowns": m.n(F.col("is_touchdown"))}, 3, "attempts", ("yards",), 25)


@query("q19_leaders_pass_yards", """
SELECT passer_athlete_id AS athlete_id, known_name, a.position, max(offense_team) AS team, count(*) AS attempts, count(*) FILTER (WHERE is_complete) AS completions, 100.0 * avg(CAST(is_complete AS INTEGER)) AS completion_pct,
  CAST(sum(yards_gained) FILTER (WHERE NOT is_turnover) AS BIGINT) AS yards, count(*) FILTER (WHERE is_turnover) AS interceptions
FROM scrimmage_wide JOIN athletes a ON athlete_id = passer_athlete_id WHERE play_kind = 'pass' GROUP BY ALL HAVING count(*) >= 5 ORDER BY yards DESC NULLS LAST, athlete_id LIMIT 25""")
def leaders_pass(t: Tables) -> DataFrame:
    measures = {"team": F.max("offense_team"), "attempts": m.n(), "completions": m.n(F.col("is_complete")), "completion_pct": m.percent("is_complete"), "yards": m.total("yards_gained", ~F.col("is_turnover")), "interceptions": m.n(F.col("is_turnover"))}
    return m.leaders(t.scrimmage_wide.where("play_kind = 'pass'"), t.athletes, "passer_athlete_id", measures, 5, "attempts", ("yards",), 25)


@query("q20_leaders_receiving_yards", """
SELECT receiver_athlete_id AS athlete_id, known_name, a.position, count(*) AS targets, count(*) FILTER (WHERE is_complete) AS receptions, CAST(sum(yards_gained) FILTER (WHERE is_complete AND NOT is_turnover) AS BIGINT) AS yards
FROM scrimmage_wide JOIN athletes a ON athlete_id = receiver_athlete_id GROUP BY ALL HAVING count(*) >= 5 ORDER BY yards DESC NULLS LAST, athlete_id LIMIT 25""")
def leaders_receiving(t: Tables) -> DataFrame:
    measures = {"targets": m.n(), "receptions": m.n(F.col("is_complete")), "yards": m.total("yards_gained", F.col("is_complete") & ~F.col("is_turnover"))}
    return m.leaders(t.scrimmage_wide, t.athletes, "receiver_athlete_id", measures, 5, "targets", ("yards",), 25)


@query("q21_leaders_tackles", """
SELECT p.athlete_id, known_name, position, count(*) AS tackles, count(*) FILTER (WHERE role = 'tackler') AS solo, count(*) FILTER (WHERE role = 'assistedBy') AS assisted
FROM people p JOIN scrim USING (play_uid) JOIN athletes a ON a.athlete_id = p.athlete_id WHERE role IN ('tackler', 'assistedBy') AND season = 1998 GROUP BY ALL HAVING count(*) >= 3 ORDER BY tackles DESC NULLS LAST, athlete_id LIMIT 25""")
def leaders_tackles(t: Tables, season: int = 1998) -> DataFrame:
    """Of a season, through the people bridge: the fact's own column names one tackler a play.  The season's plays alone are laid out by role."""
    rows = events.bridge(t.scrimmage.where(F.col("season") == season), "play_uid", [r for r in ROLES if r[0] in ("tackler", "assistedBy")], unique=True)
    return m.leaders(rows.withColumnRenamed("athlete_id", "who"), t.athletes, "who", {"tackles": m.n(), "solo": m.n(F.col("role") == "tackler"), "assisted": m.n(F.col("role") == "assistedBy")}, 3, "tackles", ("tackles",), 25)


@query("q22_fg_by_distance", """
SELECT fg_dist_bucket, CASE WHEN fg_dist_bucket = 15 THEN '<20' WHEN fg_dist_bucket = 60 THEN '60+' ELSE fg_dist_bucket || '-' || (fg_dist_bucket + 4) END AS distance_band, count(*) AS attempts, count(*) FILTER (WHERE fg_made) AS made, 100.0 * avg(CAST(fg_made AS INTEGER)) AS fg_pct
FROM play_wide WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL AND fg_dist_bucket IS NOT NULL GROUP BY 1""")
def fg_by_distance(t: Tables) -> DataFrame:
    b = F.col("fg_dist_bucket")
    band = F.when(b == 15, "<20").when(b == 60, "60+").otherwise(F.concat(b.cast("string"), F.lit("-"), (b + 4).cast("string")))
    tried = t.play_wide.where((F.col("play_kind") == "field_goal") & F.col("fg_made").isNotNull() & b.isNotNull())
    return tried.groupBy("fg_dist_bucket").agg(m.n().alias("attempts"), m.n(F.col("fg_made")).alias("made"), m.percent("fg_made").alias("fg_pct")).withColumn("distance_band", band)


@query("q23_kick_outcomes", """
SELECT season, play_kind, count(*) AS kicks, count(*) FILTER (WHERE returned IS NULL) AS unstated, 100.0 * avg(CAST(returned IS NULL AS INTEGER)) AS pct_unstated, 100.0 * avg(CAST(touchback AS INTEGER)) AS touchback_pct,
  100.0 * avg(CAST(returned AS INTEGER)) AS returned_pct, 100.0 * avg(CAST(fair_catch AS INTEGER)) AS fair_catch_pct, 100.0 * avg(CAST(out_of_bounds AS INTEGER)) AS out_of_bounds_pct, avg(return_yds) FILTER (WHERE returned) AS avg_return_yds, count(*) FILTER (WHERE returned_for_td) AS return_tds
FROM kicks WHERE play_kind IN ('kickoff', 'punt') AND NOT onside GROUP BY ALL""")
def kick_outcomes(t: Tables) -> DataFrame:
    """Rates over stated outcomes only, with the unstated share beside them; an onside kick is another play."""
    own = t.kicks.where(F.col("play_kind").isin("kickoff", "punt") & ~F.col("onside"))
    return own.groupBy("season", "play_kind").agg(
        m.n().alias("kicks"), m.n(F.col("returned").isNull()).alias("unstated"), m.percent(F.col("returned").isNull()).alias("pct_unstated"), m.percent("touchback").alias("touchback_pct"), m.percent("returned").alias("returned_pct"),
        m.percent("fair_catch").alias("fair_catch_pct"), m.percent("out_of_bounds").alias("out_of_bounds_pct"), m.mean("return_yds", F.col("returned")).alias("avg_return_yds"), m.n(F.col("returned_for_td")).alias("return_tds"),
    )


@query("q24_drive_outcomes", """
SELECT CASE WHEN start_yards_to_goal <= 20 THEN '01 inside opp 20' WHEN start_yards_to_goal <= 40 THEN '02 opp 20-40' WHEN start_yards_to_goal <= 60 THEN '03 midfield' WHEN start_yards_to_goal <= 80 THEN '04 own 20-40' ELSE '05 inside own 20' END AS start_zone,
  count(*) AS drives, 100.0 * avg(CAST(result = 'TD' AS INTEGER)) AS td_pct, 100.0 * avg(CAST(result = 'PUNT' AS INTEGER)) AS punt_pct, 100.0 * avg(CAST(is_score AS INTEGER)) AS score_pct, avg(yards) AS avg_yards, avg(plays) AS avg_plays FROM drives WHERE start_yards_to_goal > 0 GROUP BY 1""")
def drive_outcomes(t: Tables) -> DataFrame:
    """0 yards to goal is a sentinel for unknown, not the goal line."""
    y = F.col("start_yards_to_goal")
    zone = F.when(y <= 20, "01 inside opp 20").when(y <= 40, "02 opp 20-40").when(y <= 60, "03 midfield").when(y <= 80, "04 own 20-40").otherwise("05 inside own 20")
    return t.drives.where(y > 0).groupBy(zone.alias("start_zone")).agg(m.n().alias("drives"), m.percent(F.col("result") == "TD").alias("td_pct"), m.percent(F.col("result") == "PUNT").alias("punt_pct"), m.percent("is_score").alias("score_pct"), m.mean("yards").alias("avg_yards"), m.mean("plays").alias("avg_plays"))


@query("q25_situational_splits", """
SELECT down, distance_bucket, field_zone, count(*) AS plays, 100.0 * avg(CAST(first_down_gained AS INTEGER)) AS first_down_pct, avg(yards_gained) FILTER (WHERE NOT is_turnover) AS avg_yards, 100.0 * avg(CAST(is_touchdown AS INTEGER)) AS td_pct, 100.0 * avg(CAST(play_kind = 'pass' AS INTEGER)) AS pass_rate
FROM scrimmage_wide WHERE play_kind IN ('rush', 'pass', 'sack') AND down BETWEEN 1 AND 4 GROUP BY ALL""")
def situational_splits(t: Tables) -> DataFrame:
    own = t.scrimmage_wide.where(F.col("play_kind").isin(*m.SNAPS) & F.col("down").between(1, 4))
    return own.groupBy("down", "distance_bucket", "field_zone").agg(m.n().alias("plays"), m.percent("first_down_gained").alias("first_down_pct"), m.mean("yards_gained", ~F.col("is_turnover")).alias("avg_yards"), m.percent("is_touchdown").alias("td_pct"), m.percent(F.col("play_kind") == "pass").alias("pass_rate"))


#: Trends: the frame, its rows, the count and the value, and the oracle's table, rows, count and value.
TRENDS = {
    "q26_trend_fg_pct": ("kicks", "play_kind = 'field_goal' AND fg_made IS NOT NULL", lambda: m.n(), lambda: m.percent("fg_made"), "count(*)", "100.0 * avg(CAST(fg_made AS INTEGER))"),
    "q27_trend_touchback_pct": ("kicks", "play_kind = 'kickoff' AND NOT onside", lambda: m.n(F.col("returned").isNotNull()), lambda: m.percent("touchback"), "count(returned)", "100.0 * avg(CAST(touchback AS INTEGER))"),
    "q28_trend_punt_gross": ("kicks", "play_kind = 'punt' AND punt_gross_yds IS NOT NULL", lambda: m.n(), lambda: m.mean("punt_gross_yds"), "count(*)", "avg(punt_gross_yds)"),
    "q29_trend_pat_pct": ("kicks", "play_kind = 'pat' AND converted IS NOT NULL", lambda: m.n(), lambda: m.percent("converted"), "count(*)", "100.0 * avg(CAST(converted AS INTEGER))"),
    "q30_trend_completion_pct": ("scrimmage", "play_kind = 'pass' AND is_complete IS NOT NULL", lambda: m.n(), lambda: m.percent("is_complete"), "count(*)", "100.0 * avg(CAST(is_complete AS INTEGER))"),
    "q31_trend_yards_per_carry": ("scrimmage", "play_kind = 'rush' AND NOT is_turnover", lambda: m.n(), lambda: m.mean("yards_gained"), "count(*)", "avg(yards_gained)"),
    "q32_trend_yards_per_pass": ("scrimmage", "play_kind = 'pass' AND NOT is_turnover", lambda: m.n(), lambda: m.mean("yards_gained"), "count(*)", "avg(yards_gained)"),
    "q33_trend_drive_score_pct": ("drives", "true", lambda: m.n(), lambda: m.percent("is_score"), "count(*)", "100.0 * avg(CAST(is_score AS INTEGER))"),
}


def _trend(name: str) -> None:
    frame, rows, count, value, sql_count, sql_value = TRENDS[name]

    @query(name, f"SELECT season, {sql_count} AS n, {sql_value} AS value FROM {'scrim' if frame == 'scrimmage' else frame} WHERE {rows} GROUP BY season")
    def trend(t: Tables) -> DataFrame:
        return getattr(t, frame).where(rows).groupBy("season").agg(count().alias("n"), value().alias("value"))


for _name in TRENDS:
    _trend(_name)


@query("q34_team_season", """
SELECT o.team_id, o.season, o.plays AS off_plays, o.yards AS off_yards, o.pass_rate, d.plays AS def_plays, d.yards AS def_yards, k.fg_att, k.fg_made, k.punts, conference_name AS conference FROM
 (SELECT offense_team_id AS team_id, season, count(*) AS plays, CAST(sum(yards_gained) FILTER (WHERE NOT is_turnover) AS BIGINT) AS yards, 100.0 * avg(CAST(play_kind = 'pass' AS INTEGER)) AS pass_rate FROM scrim WHERE play_kind IN ('rush', 'pass', 'sack') GROUP BY ALL) o
 LEFT JOIN (SELECT defense_team_id AS team_id, season, count(*) AS plays, CAST(sum(yards_gained) FILTER (WHERE NOT is_turnover) AS BIGINT) AS yards FROM scrim WHERE play_kind IN ('rush', 'pass', 'sack') GROUP BY ALL) d USING (team_id, season)
 LEFT JOIN (SELECT kicking_team_id AS team_id, season, count(fg_made) AS fg_att, count(*) FILTER (WHERE fg_made) AS fg_made, count(*) FILTER (WHERE play_kind = 'punt') AS punts FROM kicks GROUP BY ALL) k USING (team_id, season)
 LEFT JOIN team_seasons USING (team_id, season)""")
def team_season(t: Tables) -> DataFrame:
    """Offense, defense and kicks of every team and season in one row: three aggregates joined on their keys."""
    snaps = t.scrimmage.where(F.col("play_kind").isin(*m.SNAPS))
    gained = m.total("yards_gained", ~F.col("is_turnover"))
    off = snaps.groupBy(F.col("offense_team_id").alias("team_id"), "season").agg(m.n().alias("off_plays"), gained.alias("off_yards"), m.percent(F.col("play_kind") == "pass").alias("pass_rate"))
    deff = snaps.groupBy(F.col("defense_team_id").alias("team_id"), "season").agg(m.n().alias("def_plays"), gained.alias("def_yards"))
    kicks = t.kicks.groupBy(F.col("kicking_team_id").alias("team_id"), "season").agg(F.count("fg_made").alias("fg_att"), m.n(F.col("fg_made")).alias("fg_made"), m.n(F.col("play_kind") == "punt").alias("punts"))
    out = off.join(deff, ["team_id", "season"], "left").join(kicks, ["team_id", "season"], "left")
    return out.join(t.team_seasons.select("team_id", "season", F.col("conference_name").alias("conference")), ["team_id", "season"], "left")


@query("q35_parse_quality", """
SELECT season, play_kind, count(*) AS plays, count(*) FILTER (WHERE parse_confidence = 'exact') AS exact, 100.0 * avg(CAST(parse_confidence = 'exact' AS INTEGER)) AS pct_exact, count(*) FILTER (WHERE parse_confidence IS DISTINCT FROM 'exact') AS not_exact, count(*) FILTER (WHERE kicker_athlete_id IS NULL) AS no_kicker_id FROM kicks GROUP BY ALL""")
def parse_quality(t: Tables) -> DataFrame:
    exact = F.col("parse_confidence") == "exact"
    return t.kicks.groupBy("season", "play_kind").agg(m.n().alias("plays"), m.n(exact).alias("exact"), m.percent(exact).alias("pct_exact"), m.n(~F.col("parse_confidence").eqNullSafe("exact")).alias("not_exact"), m.n(F.col("kicker_athlete_id").isNull()).alias("no_kicker_id"))


@query("q36_audit_plays", "SELECT play_uid, season, play_kind, kicking_team, kicker_name, parse_confidence FROM play_wide WHERE parse_confidence IS DISTINCT FROM 'exact' AND play_kind = 'punt' ORDER BY season DESC, play_uid LIMIT 100")
def audit_plays(t: Tables, play_kind: str | None = "punt", limit: int = 100) -> DataFrame:
    rows = fl.optional(t.play_wide.where(~F.col("parse_confidence").eqNullSafe("exact")), play_kind=play_kind)
    return rows.select("play_uid", "season", "play_kind", "kicking_team", "kicker_name", "parse_confidence").orderBy(F.desc("season"), "play_uid").limit(limit)


@query("q38_query_plays", "SELECT play_uid, season, week, offense_team_id, yards_gained FROM scrim WHERE season BETWEEN 1996 AND 1999 AND play_kind = 'rush' AND down = 3 AND (offense_team_id = 4 OR defense_team_id = 4) ORDER BY season DESC, week DESC, play_uid LIMIT 200")
def query_plays(t: Tables) -> DataFrame:
    rows = t.scrimmage.where(F.col("season").between(1996, 1999) & fl.either(4, "offense_team_id", "defense_team_id"))
    return fl.optional(rows, play_kind="rush", down=3).orderBy(F.desc("season"), F.desc("week"), "play_uid").select("play_uid", "season", "week", "offense_team_id", "yards_gained").limit(fl.clamped(200))


@query("q39_option_lists", "SELECT 'surface' AS facet, surface AS value FROM st WHERE surface IS NOT NULL GROUP BY 2 UNION ALL SELECT 'outcome', outcome FROM st GROUP BY 2 UNION ALL SELECT 'conference', conference FROM st WHERE conference IS NOT NULL GROUP BY 2")
def option_lists(t: Tables) -> DataFrame:
    """The distinct values of three facets, in one pass over the rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("surface", "outcome", "conference")])
    return t.st.select(F.inline(entries)).where("value IS NOT NULL").distinct()


@query("q40_player_picker", """
SELECT player_id, count(*) AS plays FROM (SELECT passer_athlete_id AS player_id FROM off UNION ALL SELECT rusher_athlete_id FROM off UNION ALL SELECT receiver_athlete_id FROM off) WHERE player_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 20""")
def player_picker(t: Tables, least: int = 20) -> DataFrame:
    ids = F.explode(F.array("passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id"))
    return t.off.select(ids.alias("player_id")).where("player_id IS NOT NULL").groupBy("player_id").agg(m.n().alias("plays")).where(F.col("plays") >= least)


@query("q42_kicker_leaderboard", """
, a AS (SELECT player_id, string_agg(DISTINCT team, ' · ' ORDER BY team) AS teams, count(*) AS kicks, min(season) AS first_season, max(season) AS last_season, count(DISTINCT game_id) AS games, count(*) FILTER (WHERE play_kind = 'field_goal' AND outcome <> 'Negated') AS fg_att, count(*) FILTER (WHERE outcome = 'Made') AS fg_made,
 max(fg_distance_yds) FILTER (WHERE outcome = 'Made') AS fg_long, count(*) FILTER (WHERE play_kind = 'punt') AS punts, avg(punt_gross_yds) AS punt_gross, avg(punt_net_yds) AS punt_net, count(*) FILTER (WHERE play_kind = 'kickoff') AS kickoffs, avg(kickoff_yds) AS ko_dist, count(*) FILTER (WHERE play_kind = 'kickoff' AND onside IS NOT TRUE) AS ko_denom,
 count(*) FILTER (WHERE outcome = 'Touchback') AS touchbacks, count(*) FILTER (WHERE play_kind = 'pat') AS pat_att, count(*) FILTER (WHERE play_kind = 'pat' AND outcome = 'Converted') AS pat_made, count(*) FILTER (WHERE play_kind = 'pat' AND outcome = 'Blocked') AS pat_blocked,
 count(*) FILTER (WHERE play_kind = 'two_point') AS two_att, count(*) FILTER (WHERE play_kind = 'two_point' AND outcome = 'Converted') AS two_made, count(*) FILTER (WHERE play_kind = 'defensive_conversion') AS def_conv, count(*) FILTER (WHERE outcome = 'Unknown') AS unknowns FROM st WHERE player_id IS NOT NULL GROUP BY 1)
SELECT *, CAST(fg_made AS DOUBLE) / nullif(fg_att, 0) AS fg_rate, CAST(touchbacks AS DOUBLE) / nullif(ko_denom, 0) AS tb_rate, CAST(pat_made AS DOUBLE) / nullif(pat_att, 0) AS pat_rate, CAST(two_made AS DOUBLE) / nullif(two_att, 0) AS two_rate, CAST(unknowns AS DOUBLE) / nullif(kicks, 0) AS unk_share FROM a""")
def kicker_leaderboard(t: Tables) -> DataFrame:
    return m.rolled_up(t.st.where("player_id IS NOT NULL"), ["player_id"], m.kick_measures(), m.KICK_RATES, teams=m.text_list("team"))


_SCRIM_SQL = """
, a AS (SELECT team_id, arg_max(conference, season) AS conference, count(*) AS plays, min(season) AS first_season, max(season) AS last_season, count(DISTINCT game_id) AS games, count(*) FILTER (WHERE play_kind IN ('rush', 'pass', 'sack')) AS snaps,
 avg(yards) FILTER (WHERE play_kind IN ('rush', 'pass', 'sack') AND is_turnover IS NOT TRUE) AS ypp, CAST(sum(yards) FILTER (WHERE play_kind IN ('rush', 'pass', 'sack') AND is_turnover IS NOT TRUE) AS BIGINT) AS yards_total, count(*) FILTER (WHERE first_down_gained) AS first_downs, count(*) FILTER (WHERE is_touchdown) AS tds, count(*) FILTER (WHERE is_turnover) AS turnovers,
 count(*) FILTER (WHERE play_kind = 'sack') AS sacks, count(*) FILTER (WHERE play_kind = 'rush') AS rushes, count(*) FILTER (WHERE play_kind = 'pass') AS passes, count(*) FILTER (WHERE is_complete) AS completions, count(*) FILTER (WHERE play_kind = 'penalty') AS penalties FROM LENS GROUP BY 1)
SELECT *, CAST(first_downs AS DOUBLE) / nullif(snaps, 0) AS fd_rate, CAST(completions AS DOUBLE) / nullif(passes, 0) AS comp_rate, CAST(turnovers AS DOUBLE) / nullif(snaps, 0) AS to_rate FROM a"""


@query("q43_team_rollup_offense", _SCRIM_SQL.replace("LENS", "off"))
def team_rollup_offense(t: Tables) -> DataFrame:
    return m.rolled_up(t.off, ["team_id"], m.scrimmage_measures(), m.SCRIMMAGE_RATES, conference=F.max_by("conference", "season"))


@query("q43b_team_rollup_defense", _SCRIM_SQL.replace("LENS", "deff"))
def team_rollup_defense(t: Tables) -> DataFrame:
    return m.rolled_up(t.deff, ["team_id"], m.scrimmage_measures(), m.SCRIMMAGE_RATES, conference=F.max_by("conference", "season"))


@query("q44_fg_by_season_band", "SELECT season, count(*) AS att, count(*) FILTER (WHERE outcome = 'Made') AS made, count(*) FILTER (WHERE fg_distance_yds < 40) AS short_att, count(*) FILTER (WHERE fg_distance_yds < 40 AND outcome = 'Made') AS short_made, count(*) FILTER (WHERE fg_distance_yds >= 50) AS long_att, avg(fg_distance_yds) AS mean_dist FROM st WHERE play_kind = 'field_goal' AND outcome <> 'Negated' GROUP BY 1")
def fg_by_season_band(t: Tables) -> DataFrame:
    d, made = F.col("fg_distance_yds"), F.col("outcome") == "Made"
    return t.st.where("play_kind = 'field_goal' AND outcome <> 'Negated'").groupBy("season").agg(m.n().alias("att"), m.n(made).alias("made"), m.n(d < 40).alias("short_att"), m.n((d < 40) & made).alias("short_made"), m.n(d >= 50).alias("long_att"), m.mean("fg_distance_yds").alias("mean_dist"))


@query("q48_player_phase_counts", "SELECT player_id, play_kind, count(*) AS n, min(season) AS first_season, max(season) AS last_season FROM st WHERE player_id IS NOT NULL GROUP BY ALL")
def player_phase_counts(t: Tables) -> DataFrame:
    return t.st.where("player_id IS NOT NULL").groupBy("player_id", "play_kind").agg(m.n().alias("n"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))


@query("q49_conference_history", "SELECT DISTINCT team_id, season, conference FROM st WHERE conference IS NOT NULL")
def conference_history(t: Tables) -> DataFrame:
    return t.st.where("conference IS NOT NULL").select("team_id", "season", "conference").distinct()


@query("q50_outcome_mix", "SELECT season, outcome, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY season) AS share FROM st WHERE play_kind = 'punt' GROUP BY season, outcome")
def outcome_mix(t: Tables) -> DataFrame:
    """Shares of outcomes within a season, over the counted groups (not over the plays)."""
    counts = t.st.where("play_kind = 'punt'").groupBy("season", "outcome").agg(m.n().alias("n"))
    return counts.withColumn("share", m.share_of("n", "season"))


@query("q51_make_rate_by_band", "SELECT kick_bucket, count(*) AS att, CAST(count(*) FILTER (WHERE outcome = 'Made') AS DOUBLE) / count(*) AS rate FROM st WHERE play_kind = 'field_goal' AND outcome <> 'Negated' AND kick_bucket IS NOT NULL GROUP BY 1 HAVING count(*) >= 10")
def make_rate_by_band(t: Tables) -> DataFrame:
    own = t.st.where("play_kind = 'field_goal' AND outcome <> 'Negated' AND kick_bucket IS NOT NULL")
    return own.groupBy("kick_bucket").agg(m.n().alias("att"), (m.n(F.col("outcome") == "Made") / m.n()).alias("rate")).where("att >= 10")


@query("q53_yards_by_down_kind", "SELECT down, play_kind, avg(yards) AS mean_yards, count(*) AS n FROM off WHERE down IS NOT NULL AND NOT is_turnover GROUP BY ALL")
def yards_by_down_kind(t: Tables) -> DataFrame:
    return t.off.where("down IS NOT NULL AND NOT is_turnover").groupBy("down", "play_kind").agg(m.mean("yards").alias("mean_yards"), m.n().alias("n"))


@query("q54_paged_grid", """
SELECT play_uid, season, team, outcome, kick_yds FROM st WHERE play_kind IN ('field_goal', 'punt') AND season BETWEEN 1996 AND 2000 AND (neutral_site IS FALSE) AND (kick_yds >= 40 OR kick_yds IS NULL) AND contains(lower(team), 'nation_1') ORDER BY kick_yds DESC NULLS LAST, play_uid LIMIT 50 OFFSET 100""")
def paged_grid(t: Tables) -> DataFrame:
    """Sidebar facets and a grid's filter and sort model over a lens, third page."""
    chosen = {"phases": ["field_goal", "punt"], "seasons": (1996, 2000), "neutral": "exclude"}
    model = {"kick_yds": {"operator": "OR", "conditions": [{"filterType": "number", "type": "greaterThanOrEqual", "filter": 40}, {"filterType": "number", "type": "blank"}]}, "team": {"filterType": "text", "type": "contains", "filter": "Nation_1"}}
    rows = t.st.where(fl.facets(chosen, "st") & fl.grid_filter(t.st, model))
    return fl.page(rows, fl.sort_model(t.st, [{"colId": "kick_yds", "sort": "desc"}]), 100, 150).select("play_uid", "season", "team", "outcome", "kick_yds")


@query("q56_corpus_header", "SELECT (SELECT count(*) FROM kicks) AS kicks, (SELECT count(*) FROM scrim) AS scrimmage, (SELECT count(DISTINCT game_id) FROM games) AS games, (SELECT min(season) FROM games) AS first_season, (SELECT max(season) FROM games) AS last_season")
def corpus_header(t: Tables) -> DataFrame:
    plays = t.plays.agg(m.n(F.col("fact") == "kicks").alias("kicks"), m.n(F.col("fact") == "scrimmage").alias("scrimmage"))
    games = t.games.agg(F.countDistinct("game_id").alias("games"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    return plays.crossJoin(games)  # one row each


@query("q61_season_bounds", "SELECT min(season) AS first_season, max(season) AS last_season, max(week) FILTER (WHERE season_type = 'regular') AS last_week FROM games")
def season_bounds(t: Tables) -> DataFrame:
    return t.games.agg(F.min("season").alias("first_season"), F.max("season").alias("last_season"), m.top("week", F.col("season_type") == "regular").alias("last_week"))


@query("q62_dependent_options", "SELECT DISTINCT team_id, team FROM st WHERE conference IN ('Conf 1', 'Conf 2') AND season BETWEEN 1996 AND 1997")
def dependent_options(t: Tables) -> DataFrame:
    return t.st.where(fl.facets({"conferences": ["Conf 1", "Conf 2"], "seasons": (1996, 1997)})).select("team_id", "team").distinct()
