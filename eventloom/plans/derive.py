"""Queries of the derivations: scores, uids, next events, drives, dimensions, cleaning, quality, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import clean
from eventloom.operators import dims, events, load, quality, wide
from eventloom.operators import metrics as m
from eventloom.plans.binding import ROLES, Tables
from eventloom.plans.registry import query

AS_OF = "2001-08-15 00:00:00"


def _stream(t: Tables) -> DataFrame:
    """Events as a scored feed: two sides of a user's 'game', scores that sometimes fall back."""
    e = t.raw("events")
    return e.select("event_id", "user_id", "ts", "event_type", (F.floor("value").cast("bigint") % 60).alias("home"), (F.floor(F.col("value") * 7).cast("bigint") % 60).alias("away"))


_FEED = "feed AS (SELECT event_id, user_id, ts, event_type, CAST(floor(value) AS BIGINT) % 60 AS home, CAST(floor(value * 7) AS BIGINT) % 60 AS away FROM events)"


@query("e01_score_repair", f"""WITH {_FEED}, r AS (SELECT *, greatest(coalesce(max(home) OVER w, 0), 0) AS home_fixed, greatest(coalesce(max(away) OVER w, 0), 0) AS away_fixed FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, home_fixed, away_fixed, home_fixed - lag(home_fixed, 1, 0) OVER v AS home_delta, away_fixed - lag(away_fixed, 1, 0) OVER v AS away_delta FROM r WINDOW v AS (PARTITION BY user_id ORDER BY ts, event_id)""", play_tables=False)
def score_repair(t: Tables) -> DataFrame:
    return events.repaired_scores(_stream(t), ["user_id"], ["ts", "event_id"], ["home", "away"]).select("event_id", "home_fixed", "away_fixed", "home_delta", "away_delta")


@query("e02_margin_and_scorer", f"""WITH {_FEED}, r AS (SELECT *, max(home) OVER w AS hf, max(away) OVER w AS af FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, lag(hf, 1, 0) OVER v AS hp, lag(af, 1, 0) OVER v AS ap FROM r WINDOW v AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, hp - ap AS margin_before, CASE WHEN hf - hp > af - ap THEN 'home' WHEN af - ap > hf - hp THEN 'away' END AS scorer FROM d""", play_tables=False)
def margin_and_scorer(t: Tables) -> DataFrame:
    r = events.repaired_scores(_stream(t), ["user_id"], ["ts", "event_id"], ["home", "away"])
    return r.select("event_id", events.margin_before("home_fixed", "home_delta", "away_fixed", "away_delta").alias("margin_before"), events.scorer("home_delta", "away_delta", F.lit("home"), F.lit("away")).alias("scorer"))


@query("e05_derived_conversions", "SELECT play_uid || ':pat' AS play_uid, game_id, season, NULL::INTEGER AS yards_gained, points_scored FROM scrim WHERE points_scored = 6 UNION ALL SELECT play_uid, game_id, season, yards_gained, points_scored FROM scrim WHERE points_scored = 6")
def derived_conversions(t: Tables) -> DataFrame:
    """One scoring play, two rows: itself and its conversion with the play's own measures nulled."""
    td = t.scrimmage.where("points_scored = 6").select("play_uid", "game_id", "season", "yards_gained", "points_scored")
    return events.with_conversions(td, ["yards_gained"])


@query("e07_unique_uids", "SELECT play_uid, game_id, pk, sk FROM plays")
def unique_uids(t: Tables) -> DataFrame:
    return t.plays.select("play_uid", "game_id", "pk", "sk")


@query("e08_reserved_uids", """
, n AS (SELECT *, row_number() OVER (PARTITION BY base_uid ORDER BY pk, sk, qty, flag NULLS FIRST, tail) + coalesce((SELECT count(*) FROM pl k WHERE k.fact = 'kicks' AND k.base_uid = pl.base_uid), 0) AS rn FROM pl WHERE fact = 'scrimmage')
SELECT CASE WHEN rn = 1 THEN base_uid ELSE base_uid || '#' || rn END AS own_uid, pk, sk FROM n""")
def reserved_uids(t: Tables) -> DataFrame:
    """The scrimmage fact numbers its duplicates behind those of the kicks fact."""
    p = t.plays.drop("play_uid")
    out = events.unique_uids_after(p.where("fact = 'scrimmage'"), p.where("fact = 'kicks'"), "base_uid", ("pk", "sk", "qty", "flag", "tail"), "own_uid")
    return out.select("own_uid", "pk", "sk")


@query("e13_people_by_role", """
SELECT play_uid, arg_min(athlete_id, ordinal) FILTER (WHERE role = 'passer') AS passer_athlete_id, arg_min(athlete_id, ordinal) FILTER (WHERE role = 'tackler') AS tackler_athlete_id FROM people GROUP BY 1""")
def people_by_role(t: Tables) -> DataFrame:
    return events.first_by_role(t.people_with("game_id"), "play_uid", ["passer", "tackler"], within=["game_id"])


@query("e14_bridge", "SELECT play_uid, role, athlete_id, ordinal FROM people")
def bridge(t: Tables) -> DataFrame:
    return t.people


@query("e15_drives", "SELECT game_id, drive_number, season, offense_team_id, start_yards_to_goal, end_yards_to_goal, plays, yards, is_score, result FROM drives")
def drives(t: Tables) -> DataFrame:
    return t.drives.drop("drive_id")


@query("e17_last_play", "SELECT game_id, arg_max(play_uid, (seq, play_uid)) AS play_uid, arg_max(score_diff, (seq, play_uid)) AS score_diff FROM (SELECT game_id, play_uid, seq, coalesce(score_diff, 0) AS score_diff FROM plays) GROUP BY 1")
def last_play(t: Tables) -> DataFrame:
    p = t.plays.select("game_id", "play_uid", "seq", F.coalesce("score_diff", F.lit(0)).alias("score_diff"))
    return events.last_of(p, ["game_id"], ["seq", "play_uid"], "play_uid", "score_diff")


@query("e18_next_event", """
SELECT a.event_id, (SELECT b.event_id FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'purchase' AND (b.ts, b.event_id) > (a.ts, a.event_id) ORDER BY b.ts, b.event_id LIMIT 1) AS next_purchase FROM events a WHERE a.event_type = 'click'""", play_tables=False)
def next_purchase(t: Tables) -> DataFrame:
    """For each click the user's next purchase: a window over one sorted stream, not a range join."""
    kind = F.col("event_type")
    out = events.next_event(t.raw("events"), ["user_id"], ["ts", "event_id"], kind == "click", kind == "purchase", F.col("event_id"), "next_purchase")
    return out.where(kind == "click").select("event_id", "next_purchase")


@query("e19_season_to_date", """
SELECT play_uid, CAST(sum(CASE WHEN fg_made THEN 1 ELSE 0 END) OVER w AS BIGINT) AS made_before, CAST(sum(CASE WHEN fg_made IS NOT NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS tried_before FROM kicks WHERE play_kind = 'field_goal' AND kicker_athlete_id IS NOT NULL
WINDOW w AS (PARTITION BY kicker_athlete_id, season ORDER BY kickoff_utc, play_uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def season_to_date(t: Tables) -> DataFrame:
    fg = t.kicks.where("play_kind = 'field_goal' AND kicker_athlete_id IS NOT NULL")
    sums = {"made_before": F.when(F.col("fg_made"), 1).otherwise(0), "tried_before": F.when(F.col("fg_made").isNotNull(), 1).otherwise(0)}
    return events.so_far(fg, ["kicker_athlete_id", "season"], ["kickoff_utc", "play_uid"], sums).select("play_uid", "made_before", "tried_before")


@query("c01_typed_staging", "SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 = 0 END AS flag FROM events", play_tables=False)
def typed_staging(t: Tables) -> DataFrame:
    """All-text rows ('12.0', '', 'true') typed without an error."""
    text = t.raw("events").select(F.col("event_id").cast("string").alias("event_id"), F.concat(F.get_json_object("props", "$.k"), F.lit(".0 ")).alias("k"), F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 2 == 0, "true").otherwise("false").alias("flag"))
    return clean.typed(text, {"event_id": "int", "k": "int", "flag": "bool"})


@query("c04_bounded", "SELECT play_uid, CASE WHEN abs(yards_gained) <= 110 THEN yards_gained END AS yards, coalesce(abs(yards_gained) > 110, false) AS impossible FROM scrim")
def bounded(t: Tables) -> DataFrame:
    return t.scrimmage.select("play_uid", clean.bounded("yards_gained", -110, 110).alias("yards"), F.coalesce(F.abs("yards_gained") > 110, F.lit(False)).alias("impossible"))


@query("c06_clock", "SELECT play_uid, clock_secs_period AS seconds FROM scrim")
def clock(t: Tables) -> DataFrame:
    """Seconds to 'mm:ss' and back."""
    return t.scrimmage.select("play_uid", clean.clock_seconds(clean.seconds_label("clock_secs_period")).alias("seconds"))


@query("c14_upsert", "SELECT v.venue_id, CASE WHEN v.venue_id % 3 = 0 THEN 'new' ELSE surface END AS surface, CASE WHEN v.venue_id % 3 = 0 THEN coalesce(NOT indoor, NULL, indoor) ELSE indoor END AS indoor FROM venues v UNION ALL SELECT -1, 'new', NULL")
def upsert(t: Tables) -> DataFrame:
    old = t.venues.select("venue_id", "surface", "indoor")
    extra = t.spark.range(-1, 0).select(F.col("id").alias("venue_id"), F.lit("new").alias("surface"), F.lit(None).cast("boolean").alias("indoor"))
    news = old.where("venue_id % 3 = 0").select("venue_id", F.lit("new").alias("surface"), (~F.col("indoor")).alias("indoor")).unionByName(extra)
    return load.upserted(old, news, ["venue_id"])


@query("c15_insert_new", "SELECT team_id, display_name FROM teams UNION ALL SELECT 100, 'fresh'")
def insert_new(t: Tables) -> DataFrame:
    old = t.teams.select("team_id", "display_name")
    news = t.spark.range(2).select((F.col("id") * 97 + 3).alias("team_id"), F.lit("fresh").alias("display_name"))
    return load.inserted_new(old, news, ["team_id"])


@query("d01_precedence", "SELECT team_id, season, arg_min(cls, (CASE cls WHEN 'FBS' THEN 0 ELSE 1 END, pos)) AS cls FROM (SELECT o_custkey % 25 AS team_id, CAST(year(o_orderdate) AS INTEGER) AS season, CASE WHEN o_orderkey % 7 = 0 THEN 'FBS' ELSE 'FCS' END AS cls, o_orderkey AS pos FROM orders) GROUP BY ALL", play_tables=False)
def precedence(t: Tables) -> DataFrame:
    """Of conflicting claims about a team's division the top one wins, else the first."""
    claims = t.raw("orders").select((F.col("o_custkey") % 25).alias("team_id"), F.year("o_orderdate").alias("season"), F.when(F.col("o_orderkey") % 7 == 0, "FBS").otherwise("FCS").alias("cls"), F.col("o_orderkey").alias("pos"))
    return dims.by_precedence(claims, ["team_id", "season"], [F.when(F.col("cls") == "FBS", 0).otherwise(1), F.col("pos")], ["cls"])


@query("d06_latest_file", "SELECT l_orderkey AS game, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, year(l_shipdate) AS season, l_suppkey % 3 AS ord FROM lineitem) x WHERE ord = (SELECT max(l_suppkey % 3) FROM lineitem y WHERE year(y.l_shipdate) = x.season) GROUP BY 1", play_tables=False)
def latest_file(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select(F.col("l_orderkey").alias("game"), F.concat_ws("/", "l_orderkey", "l_linenumber", F.year("l_shipdate")).alias("uid"), F.year("l_shipdate").alias("season"), (F.col("l_suppkey") % 3).alias("ord"))
    return dims.latest_file_owns(rows, "season", "ord", "uid").groupBy("game").agg(m.n().alias("n"))


@query("d11_modal_role", "SELECT athlete_id, arg_max(role, (n, role)) AS role FROM (SELECT athlete_id, role, count(*) AS n FROM people GROUP BY ALL) GROUP BY 1")
def modal_role(t: Tables) -> DataFrame:
    return dims.modal_by_key(t.people, "athlete_id", "role", "role")


@query("d12_careers", "SELECT athlete_id, min(season) AS first_season, max(season) AS last_season, count(DISTINCT play_uid) AS plays, (SELECT arg_max(role, (n, role)) FROM (SELECT role, count(*) AS n FROM people q WHERE q.athlete_id = p.athlete_id GROUP BY role)) AS primary_role FROM people p JOIN scrim USING (play_uid) GROUP BY athlete_id")
def careers(t: Tables) -> DataFrame:
    return dims.careers_of(events.entries(t.scrimmage, ROLES, ["season"]))


@query("d14_season_status", f"SELECT season, count(DISTINCT game_id) AS games, count(*) AS plays, max(week) FILTER (WHERE season_type = 'regular') AS last_regular_week, max(kickoff_utc) AS last_kickoff, max(kickoff_utc) > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAYS AS is_in_progress FROM kicks GROUP BY 1")
def season_status(t: Tables) -> DataFrame:
    return dims.season_status(t.kicks, AS_OF)


@query("w01_play_wide", "SELECT play_uid, kicking_team, receiving_conference, kicker_known_name, venue_name, game_secs_remaining, is_clutch, fg_dist_bucket, game_month, both_top_division FROM play_wide")
def play_wide(t: Tables) -> DataFrame:
    return t.play_wide.select("play_uid", "kicking_team", "receiving_conference", "kicker_known_name", "venue_name", "game_secs_remaining", "is_clutch", "fg_dist_bucket", "game_month", "both_top_division")


@query("w02_scrimmage_wide", "SELECT play_uid, offense_team, defense_conference, passer_name, tackler_name, surface, game_secs_remaining, is_clutch, distance_bucket, field_zone FROM scrimmage_wide")
def scrimmage_wide(t: Tables) -> DataFrame:
    return t.scrimmage_wide.select("play_uid", "offense_team", "defense_conference", "passer_name", "tackler_name", "surface", "game_secs_remaining", "is_clutch", "distance_bucket", "field_zone")


_ST = "play_uid, outcome, outcome_unknown, player, player_name_unparsed, team, opponent, site, kick_yds, kick_bucket, clock, down, score_diff, score_state, game_date"


@query("w08_kick_lens", f"SELECT {_ST} FROM st")
def kick_lens(t: Tables) -> DataFrame:
    return t.st.select(*_ST.split(", "))


_OFF = "play_uid, outcome, outcome_unknown, yards, yards_impossible, yards_bucket, points_scored, player_id, team, opp_id, site, score_diff, score_state"


@query("w10_offense_lens", f"SELECT {_OFF} FROM off")
def offense_lens(t: Tables) -> DataFrame:
    return t.off.select(*_OFF.split(", "))


@query("w10b_defense_lens", f"SELECT {_OFF} FROM deff")
def defense_lens(t: Tables) -> DataFrame:
    return t.deff.select(*_OFF.split(", "))


@query("j03_conference_trap", """
, latest AS (SELECT team_id, arg_max(conference_name, season) AS latest_conference FROM team_seasons GROUP BY 1)
SELECT w.season, count(*) AS plays, count(*) FILTER (WHERE offense_conference <> latest_conference) AS wrong FROM scrimmage_wide w JOIN latest ON team_id = offense_team_id GROUP BY 1""")
def conference_trap(t: Tables) -> DataFrame:
    """How many plays a join on the team alone would give the wrong conference."""
    joined = t.scrimmage_wide.join(wide.latest_only(t.team_seasons), F.col("offense_team_id") == F.col("team_id"))
    return joined.groupBy("season").agg(m.n().alias("plays"), m.n(F.col("offense_conference") != F.col("latest_conference")).alias("wrong"))


@query("j06_semi_join", "SELECT venue_id, venue_name FROM venues v WHERE EXISTS (SELECT 1 FROM games g WHERE g.venue_id = v.venue_id AND season = 1999)")
def used_venues(t: Tables) -> DataFrame:
    return t.venues.select("venue_id", "venue_name").join(t.games.where("season = 1999"), "venue_id", "left_semi")


@query("j07_anti_join", "SELECT game_id FROM games g WHERE NOT EXISTS (SELECT 1 FROM kicks k WHERE k.game_id = g.game_id)")
def games_without_kicks(t: Tables) -> DataFrame:
    return t.games.select("game_id").join(t.kicks, "game_id", "left_anti")


@query("j10_theta_self_join", """, s AS (SELECT DISTINCT kicker_athlete_id AS aid, season FROM kicks WHERE kicker_athlete_id IS NOT NULL AND play_kind = 'punt')
SELECT a.aid, a.season, count(*) AS later FROM s a JOIN s b ON b.aid = a.aid AND b.season > a.season GROUP BY ALL""")
def later_seasons(t: Tables) -> DataFrame:
    """Seasons still to come per player-season: an equi-join with a range beside it, over distinct pairs."""
    s = t.kicks.where("kicker_athlete_id IS NOT NULL AND play_kind = 'punt'").select(F.col("kicker_athlete_id").alias("aid"), "season").distinct()
    later = s.select(F.col("aid").alias("b_aid"), F.col("season").alias("b_season"))
    return s.join(later, (F.col("aid") == F.col("b_aid")) & (F.col("b_season") > F.col("season"))).groupBy("aid", "season").agg(m.n().alias("later"))


@query("j12_full_outer", "SELECT coalesce(k.game_id, s.game_id) AS game_id, k.n AS kicks, s.n AS scrimmage FROM (SELECT game_id, count(*) AS n FROM kicks GROUP BY 1) k FULL JOIN (SELECT game_id, count(*) AS n FROM scrim GROUP BY 1) s USING (game_id)")
def game_counts(t: Tables) -> DataFrame:
    """Plays of either fact by game; a game may be in one fact alone."""
    k = t.kicks.groupBy("game_id").agg(m.n().alias("kicks"))
    return k.join(t.scrimmage.groupBy("game_id").agg(m.n().alias("scrimmage")), "game_id", "full_outer")


@query("u03_except_all", """, a AS (SELECT season, week FROM kicks), b AS (SELECT season, week FROM scrim)
SELECT season, week, 'a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT season, week, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def parity(t: Tables) -> DataFrame:
    return quality.difference(t.kicks.select("season", "week"), t.scrimmage.select("season", "week"))


@query("a15_cube", "SELECT season, fg_dist_bucket AS band, count(*) AS att, CAST(sum(CAST(fg_made AS INTEGER)) AS BIGINT) AS made, CAST(grouping_id(season, fg_dist_bucket) AS BIGINT) AS level FROM play_wide WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL GROUP BY CUBE (season, fg_dist_bucket)")
def fg_cube(t: Tables) -> DataFrame:
    """Season x band with every total, in one cube."""
    own = t.play_wide.where("play_kind = 'field_goal' AND fg_made IS NOT NULL").withColumnRenamed("fg_dist_bucket", "band")
    return own.cube("season", "band").agg(m.n().alias("att"), F.sum(F.col("fg_made").cast("int")).alias("made"), F.grouping_id("season", "band").alias("level"))


_HASHED = "CAST(coalesce(sum(CAST('0x' || substr(md5(to_json({'play_uid': play_uid, 'game_id': game_id, 'play_kind': play_kind})), 1, 15) AS BIGINT)), 0) AS VARCHAR)"


@query("a21_checksum", f"SELECT 'kicks' AS name, count(*) AS n, {_HASHED} AS sum FROM kicks UNION ALL SELECT 'scrim', count(*), {_HASHED} FROM scrim")
def checksums(t: Tables) -> DataFrame:
    """Of the facts' ids and kinds, whatever the order of their rows."""
    parts = [quality.checksum(df, "play_uid", "game_id", "play_kind").select(F.lit(name).alias("name"), "n", F.col("sum").cast("string").alias("sum")) for name, df in (("kicks", t.kicks), ("scrim", t.scrimmage))]
    return parts[0].unionByName(parts[1])


@query("a16_row_counts", "SELECT 'kicks' AS name, count(*) AS n FROM kicks UNION ALL SELECT 'scrim', count(*) FROM scrim")
def row_counts(t: Tables) -> DataFrame:
    return quality.row_counts(kicks=t.kicks, scrim=t.scrimmage)


@query("v01_uid_unique_across_facts", "SELECT play_uid, count(*) AS n FROM (SELECT play_uid FROM kicks UNION ALL SELECT play_uid FROM scrim) GROUP BY 1 HAVING count(*) > 1")
def uid_unique(t: Tables) -> DataFrame:
    return quality.not_unique(t.kicks.select("play_uid").unionByName(t.scrimmage.select("play_uid")), "play_uid")


@query("v01b_nulls", "SELECT * FROM (SELECT 'clock_secs_period' AS \"column\", count(*) FILTER (WHERE clock_secs_period IS NULL) AS n FROM kicks UNION ALL SELECT 'returned', count(*) FILTER (WHERE returned IS NULL) FROM kicks UNION ALL SELECT 'season', count(*) FILTER (WHERE season IS NULL) FROM kicks) WHERE n > 0")
def nulls(t: Tables) -> DataFrame:
    return quality.nulls_in(t.kicks, "clock_secs_period", "returned", "season")


@query("v01c_accepted_values", "SELECT play_kind AS value, count(*) AS n FROM scrim WHERE play_kind NOT IN ('rush', 'pass', 'sack') GROUP BY 1")
def accepted_values(t: Tables) -> DataFrame:
    return quality.not_accepted(t.scrimmage, "play_kind", ["rush", "pass", "sack"])


@query("v03_equal_rowcount", "SELECT count(*) AS fact_rows, (SELECT count(*) FROM scrimmage_wide) AS wide_rows FROM scrim")
def equal_rowcount(t: Tables) -> DataFrame:
    return t.scrimmage.agg(m.n().alias("fact_rows")).crossJoin(t.scrimmage_wide.agg(m.n().alias("wide_rows")))  # one row each


@query("v05_not_monotonic", "SELECT * FROM (SELECT fg_dist_bucket, 100.0 * avg(CAST(fg_made AS INTEGER)) AS pct, lag(100.0 * avg(CAST(fg_made AS INTEGER))) OVER (ORDER BY fg_dist_bucket) AS before FROM play_wide WHERE fg_made IS NOT NULL GROUP BY 1) WHERE pct > before")
def not_monotonic(t: Tables) -> DataFrame:
    bands = t.play_wide.where("fg_made IS NOT NULL").groupBy("fg_dist_bucket").agg(m.percent("fg_made").alias("pct"))
    return quality.not_monotonic(bands, "fg_dist_bucket", "pct")


@query("v11_unknown_rate", "SELECT season, count(*) AS n, 100.0 * avg(CAST(outcome_unknown AS INTEGER)) AS unknown_pct FROM st GROUP BY 1")
def unknown_rate(t: Tables) -> DataFrame:
    return t.st.groupBy("season").agg(m.n().alias("n"), m.percent("outcome_unknown").alias("unknown_pct"))


@query("v13_null_semantics", "SELECT count(*) FILTER (WHERE play_kind = 'sack' AND is_complete IS NOT NULL) AS complete_sacks, count(*) FILTER (WHERE play_kind = 'pass' AND is_complete IS NULL) AS unstated_passes FROM scrim")
def null_semantics(t: Tables) -> DataFrame:
    k = F.col("play_kind")
    return t.scrimmage.agg(m.n((k == "sack") & F.col("is_complete").isNotNull()).alias("complete_sacks"), m.n((k == "pass") & F.col("is_complete").isNull()).alias("unstated_passes"))


@query("i01_missing_games", "SELECT game_id FROM games WHERE kickoff_utc >= TIMESTAMP '2001-07-20' AND game_id NOT IN (SELECT game_id FROM kicks)")
def missing_games(t: Tables) -> DataFrame:
    return load.missing_events(t.games, t.kicks, "game_id", "2001-07-20", "kickoff_utc").select("game_id")
