"""Queries of intake and comparison: conversions, kinds by people, reparse, copies, corpora, kickoff eras, paired programs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import compare, conversions, corpora, dims, events, load
from eventloom.plans.binding import ROLES, UID_ORDER, Tables
from eventloom.plans.panels import next_snap
from eventloom.plans.registry import query

#: A scoring feed over the kicks of a game, in words that both dialects read.  Three rows share a sequence number.
FEED = {
    "base_uid": "concat('t:', cast(game_id as varchar(20)), ':', cast(seq % 3 as varchar(20)))",
    **{c: c for c in ("game_id", "season", "seq", *UID_ORDER, "home_team_id", "away_team_id")},
    "play_type": "CASE pk % 12 WHEN 0 THEN 'Two Point Pass' WHEN 1 THEN 'Two Point Rush' WHEN 2 THEN 'Defensive 2pt Conversion' WHEN 3 THEN 'Passing Touchdown' WHEN 4 THEN 'Rushing Touchdown' ELSE 'Kickoff' END",
    "play_text": "CASE pk % 7 WHEN 0 THEN 'Two-Point Conversion failed' WHEN 1 THEN 'Pass is no good' WHEN 2 THEN 'thrown and Intercepted' WHEN 3 THEN NULL WHEN 4 THEN 'run in, Kick attempt good' WHEN 5 THEN '' ELSE 'pass good' END",
    "scoring": "flag",
    "home_points": "cast(CASE WHEN flag AND sk % 3 = 0 THEN 2 ELSE 0 END as int)",
    "away_points": "cast(CASE WHEN flag AND sk % 3 = 1 THEN 2 ELSE 0 END as int)",
    "start_team_id": "CASE WHEN pk % 5 = 0 THEN NULL ELSE own_team_id END",
    "yards": "qty", "distance": "distance", "kickoff_yds": "cast(40 + pk % 31 as int)",
}
TOUCHDOWNS = ("Passing Touchdown", "Rushing Touchdown")
#: Measures of the touchdown itself, which its conversion has none of.
NULLED = ("yards", "distance", "kickoff_yds")
_FEED = f"""
, f0 AS (SELECT {', '.join(f'{e} AS {n}' for n, e in FEED.items())} FROM pl WHERE fact = 'kicks'),
feed AS (SELECT *, coalesce(sum(home_points) OVER w, 0) AS home_before, coalesce(sum(away_points) OVER w, 0) AS away_before,
    CASE WHEN home_points > away_points THEN home_team_id WHEN away_points > home_points THEN away_team_id END AS scorer, lower(coalesce(play_text, '')) AS low
  FROM f0 WINDOW w AS (PARTITION BY game_id ORDER BY seq, {', '.join(c + ' NULLS FIRST' for c in UID_ORDER)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _feed(t: Tables) -> DataFrame:
    rows = t.plays.where("fact = 'kicks'").selectExpr(*[f"{e} AS {n}" for n, e in FEED.items()])
    before = events.so_far(rows, ["game_id"], ["seq", *UID_ORDER], {"home_before": F.col("home_points"), "away_before": F.col("away_points")})
    return before.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("home_before", "away_before")})


@query("e06_conversions", _FEED + f"""
, rows_ AS (
  SELECT *, base_uid AS base, 0 AS emit_rank, 'kickoff' AS play_kind, NULL::BOOLEAN AS converted, NULL::VARCHAR AS two_point_type, 'exact' AS parse_confidence FROM feed WHERE play_type = 'Kickoff'
  UNION ALL BY NAME
  SELECT * REPLACE (NULL::INTEGER AS yards, NULL::INTEGER AS distance, NULL::INTEGER AS kickoff_yds), base_uid || ':pat' AS base, 0 AS emit_rank, if(contains(low, 'two-point'), 'two_point', 'pat') AS play_kind,
    CASE WHEN regexp_matches(low, '{conversions.FAILED}') THEN false WHEN contains(low, 'good') THEN true END AS converted, NULL::VARCHAR AS two_point_type,
    if(regexp_matches(low, '{conversions.FAILED}') OR contains(low, 'good'), 'exact', 'partial') AS parse_confidence
  FROM feed WHERE play_type IN {TOUCHDOWNS} AND (scoring IS TRUE OR contains(low, 'kick attempt'))
  UNION ALL BY NAME
  SELECT *, base_uid AS base, 1 AS emit_rank, if(play_type LIKE 'Two%', 'two_point', 'defensive_conversion') AS play_kind,
    play_type NOT LIKE 'Two%' OR (scoring IS TRUE AND scorer IS NOT NULL AND NOT regexp_matches(low, '{conversions.FAILED}')) AS converted,
    CASE play_type WHEN 'Two Point Pass' THEN 'pass' WHEN 'Two Point Rush' THEN 'rush' END AS two_point_type, if(low <> '', 'exact', 'partial') AS parse_confidence
  FROM feed WHERE play_type LIKE 'Two Point%' OR play_type LIKE 'Defensive%'),
sided AS (SELECT *, if(play_kind = 'kickoff', start_team_id, coalesce(scorer, start_team_id)) AS team FROM rows_),
n AS (SELECT *, row_number() OVER (PARTITION BY game_id, base ORDER BY emit_rank, {', '.join(c + ' NULLS FIRST' for c in UID_ORDER)}) AS rn FROM sided)
SELECT if(rn = 1, base, base || '#' || rn) AS play_uid, game_id, pk, play_kind, converted, two_point_type, parse_confidence, team AS kicking_team_id,
  CASE WHEN team = home_team_id THEN away_team_id WHEN team IS NOT NULL THEN home_team_id END AS receiving_team_id, team = home_team_id AS is_home_kicking,
  CAST(CASE WHEN team = home_team_id THEN home_before - away_before WHEN team IS NOT NULL THEN away_before - home_before END AS BIGINT) AS score_diff_kicking, yards, distance, kickoff_yds FROM n""")
def conversion_rows(t: Tables) -> DataFrame:
    """Kicks, the conversions told by touchdowns and the feed's own, each with its uid: kicks keep the bare one."""
    feed = _feed(t)
    kick = {"play_kind": F.lit("kickoff"), "converted": F.lit(None).cast("boolean"), "two_point_type": F.lit(None).cast("string"), "parse_confidence": F.lit("exact")}
    out = conversions.emitted_by(feed, F.col("play_type") == "Kickoff", kick, UID_ORDER, TOUCHDOWNS, NULLED)
    return out.select(
        "play_uid", "game_id", "pk", "play_kind", "converted", "two_point_type", "parse_confidence", "kicking_team_id", "receiving_team_id",
        "is_home_kicking", F.col("score_diff_kicking").cast("bigint").alias("score_diff_kicking"), *NULLED,
    )


#: The feed's type of a scrimmage play: what was called, or what came of it.
TYPE_OF_PLAY = """CASE length(play_uid) * 7 + seq * 3 + coalesce(clock_secs_period, 0) % 13 WHEN 0 THEN '' ELSE
  CASE (seq * 5 + coalesce(clock_secs_period, 0)) % 12 WHEN 0 THEN 'Rush' WHEN 1 THEN 'Pass Reception' WHEN 2 THEN 'Pass Incompletion' WHEN 3 THEN 'Sack' WHEN 4 THEN 'Penalty' WHEN 5 THEN 'Interception'
    WHEN 6 THEN 'Pass Interception Return' WHEN 7 THEN 'Fumble Recovery (Own)' WHEN 8 THEN 'Fumble Recovery (Opponent)' WHEN 9 THEN 'Safety' WHEN 10 THEN 'Timeout' ELSE '' END END"""


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query("e09_kinds_by_people", f"""
, y AS (SELECT play_uid, {TYPE_OF_PLAY} AS play_type FROM scrim),
r AS (SELECT play_uid, list(role) AS roles FROM people GROUP BY 1),
k AS (SELECT play_uid, play_type, CASE {' '.join(f"WHEN play_type = '{a}' THEN '{b}'" for a, b in events.KIND_BY_TYPE.items())}
   WHEN play_type IN {_in(events.OUTCOME_TYPES)} AND list_contains(roles, 'passer') THEN 'pass' WHEN play_type IN {_in(events.OUTCOME_TYPES)} AND list_contains(roles, 'rusher') THEN 'rush' ELSE 'other' END AS play_kind FROM y LEFT JOIN r USING (play_uid))
SELECT play_uid, play_type, play_kind, CASE WHEN play_kind <> 'pass' THEN NULL WHEN play_type IN {_in(k for k, v in events.COMPLETE_BY_TYPE.items() if v)} THEN true WHEN play_type IN {_in(k for k, v in events.COMPLETE_BY_TYPE.items() if not v)} THEN false END AS is_complete FROM k""")
def kinds_by_people(t: Tables) -> DataFrame:
    """Kind and completion from the feed's type, and from who took part where the type only tells the outcome."""
    plays = t.scrimmage.selectExpr("play_uid", f"{TYPE_OF_PLAY} AS play_type")
    return events.kinds_by_people(plays, t.people)


#: A later parse of the kicks: what it reads otherwise.
REPARSED = {
    "punt_net_yds": "CASE WHEN kick_blocked THEN NULL ELSE punt_net_yds END",
    "kicker_name": "CASE WHEN kicker_name LIKE '(%' THEN NULL ELSE kicker_name END",
    "parse_confidence": "coalesce(parse_confidence, 'partial')",
}


@query("c18_reparse", f"""SELECT play_uid, {', '.join(f'{e} AS {c}' for c, e in REPARSED.items())}, {' OR '.join(f'({e}) IS DISTINCT FROM {c}' for c, e in REPARSED.items())} AS was_changed,
  {', '.join(f'{c} AS {c}_back' for c in REPARSED)} FROM kicks""")
def reparse_and_undo(t: Tables) -> DataFrame:
    """Three columns of the kicks taken from a later parse, and what undoing it gives."""
    columns = list(REPARSED)
    stored = t.kicks.select("play_uid", "season", *columns, "kick_blocked")
    staged = stored.selectExpr("play_uid", *[f"{e} AS {c}" for c, e in REPARSED.items()])
    new, before = load.reparsed(stored, staged, "play_uid", columns)
    back = load.undone(new, before, "play_uid", columns).select("play_uid", *[F.col(c).alias(f"{c}_back") for c in columns])
    marked = new.join(before.select("play_uid", F.lit(True).alias("was_changed")), "play_uid", "left").fillna({"was_changed": False})
    return marked.join(back, "play_uid").select("play_uid", *columns, "was_changed", *[f"{c}_back" for c in columns])


COPIED = ("season", "play_kind", "fg_made", "punt_gross_yds", "kicker_name")
#: Faults planted in the copy: two columns of some rows, and rows that only one side has.
FAULTS = {"fg_made": "CASE WHEN length(play_uid) % 3 = 0 AND seq = 2 THEN NOT fg_made ELSE fg_made END", "kicker_name": "CASE WHEN seq = 5 AND kicker_name IS NULL THEN '' ELSE kicker_name END"}
_COPY = ", ".join(f"{FAULTS.get(c, c)} AS {c}" for c in COPIED)


@query("v10_column_diagnosis", f"""
, a AS (SELECT play_uid, {', '.join(COPIED)} FROM kicks WHERE seq <> 7), b AS (SELECT play_uid, {_COPY} FROM kicks WHERE NOT (seq = 1 AND game_id % 50 = 1)),
j AS (SELECT coalesce(a.play_uid, b.play_uid) AS play_uid, a.play_uid IS NULL AS no_a, b.play_uid IS NULL AS no_b, {', '.join(f'CAST(a.{c} AS VARCHAR) AS a_{c}, CAST(b.{c} AS VARCHAR) AS b_{c}' for c in COPIED)} FROM a FULL JOIN b ON a.play_uid = b.play_uid)
SELECT play_uid, NULL AS "column", if(no_a, 'b', 'a') AS found, NULL AS in_a, NULL AS in_b FROM j WHERE no_a OR no_b
""" + "".join(f" UNION ALL SELECT play_uid, '{c}', 'both', a_{c}, b_{c} FROM j WHERE NOT no_a AND NOT no_b AND a_{c} IS DISTINCT FROM b_{c}" for c in COPIED))
def column_diagnosis(t: Tables) -> DataFrame:
    """Two copies of the kicks: faults planted in one are named by column and key."""
    copy = lambda side, rows, faults: F.when(F.expr(rows), F.struct(F.lit(side).alias("side"), *[F.expr(faults.get(c, c)).alias(c) for c in COPIED]))
    both = F.array(copy("a", "seq <> 7", {}), copy("b", "NOT (seq = 1 AND game_id % 50 = 1)", FAULTS))
    sides = t.kicks.select("play_uid", F.inline(F.filter(both, lambda e: e.isNotNull())))
    return compare.differences_of(sides, ["play_uid"], COPIED, t.tasks)


CORPORA = ("cfb", "nfl")
LEAGUE = "CASE WHEN game_id % 4 = 0 THEN 'nfl' ELSE 'cfb' END"


def _corpora(t: Tables) -> dict[str, dict[str, DataFrame]]:
    marked = lambda df: df.withColumn("league", F.expr(LEAGUE))
    return {c: corpora.part(c, marked(t.games), {"kicks": marked(t.kicks), "scrimmage": marked(t.scrimmage)}, {"people": (t.people, "scrimmage")}, {"venues": (t.venues, "venue_id")}) for c in CORPORA}


@query("c20_corpora", f"""
, gl AS (SELECT *, {LEAGUE} AS league FROM games), s AS (SELECT *, {LEAGUE} AS league FROM scrim)
SELECT league, 'games' AS name, count(*) AS n FROM gl GROUP BY 1 UNION ALL SELECT {LEAGUE}, 'kicks', count(*) FROM kicks GROUP BY 1 UNION ALL SELECT league, 'scrimmage', count(*) FROM s GROUP BY 1
UNION ALL SELECT league, 'people', count(*) FROM people JOIN s USING (play_uid) GROUP BY 1
UNION ALL SELECT l.league, 'venues', count(*) FROM venues v, (SELECT DISTINCT league FROM gl) l WHERE EXISTS (SELECT 1 FROM gl WHERE gl.venue_id = v.venue_id AND gl.league = l.league) GROUP BY 1
UNION ALL SELECT 'lost', 'people', 0""")
def split_corpora(t: Tables) -> DataFrame:
    """Rows of every table of each corpus, and the rows of the bridge that no corpus has."""
    parts = _corpora(t)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("league"), F.lit(name).alias("name"), "n") for c, tables in parts.items() for name, df in tables.items()]
    lost = t.people.exceptAll(parts["cfb"]["people"].unionByName(parts["nfl"]["people"])).agg(F.count(F.lit(1)).alias("n")).select(F.lit("lost").alias("league"), F.lit("people").alias("name"), "n")
    out = lost
    for c in counts:
        out = out.unionByName(c)
    return out


@query("s10_corpus_kicks", f"SELECT 'nfl' AS corpus, play_uid, season, play_kind FROM kicks WHERE {LEAGUE} = 'nfl' UNION ALL SELECT 'cfb', play_uid, season, play_kind FROM kicks WHERE {LEAGUE} = 'cfb'")
def corpus_kicks(t: Tables) -> DataFrame:
    """Each corpus asked for its kicks: the answers are the corpora's own rows."""
    own = [tables["kicks"].select(F.lit(c).alias("corpus"), "play_uid", "season", "play_kind") for c, tables in _corpora(t).items()]
    return own[0].unionByName(own[1])


#: Kicks of a kind in a season from which a job counts as done, and below which it counts as not done.
MANY, FEW = 6, 3


@query("r04_kickoff_era", f"""
, s AS (SELECT game_id, seq, play_uid, receiving_team_id AS team_id, 1 AS q, NULL::INTEGER AS y FROM kicks WHERE play_kind = 'kickoff' UNION ALL SELECT game_id, seq, play_uid, offense_team_id, 0, yards_to_goal FROM scrim),
w AS (SELECT *, first_value(CASE WHEN q = 0 THEN y END IGNORE NULLS) OVER (PARTITION BY game_id, team_id ORDER BY seq, play_uid ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM s),
o AS (SELECT k.season, kicker_athlete_id AS aid, CASE WHEN returned IS NOT NULL AND touchback IS NOT NULL THEN CAST(touchback AS INTEGER) END AS tb, 100 - nxt AS start FROM kicks k JOIN w ON w.play_uid = k.play_uid AND q = 1 WHERE k.play_kind = 'kickoff' AND NOT onside AND kicker_athlete_id IS NOT NULL),
own AS (SELECT season, aid, count(*) AS kickoffs, count(tb) AS tn, coalesce(sum(tb), 0) AS ts, count(start) AS sn, coalesce(sum(start), 0) AS ss FROM o GROUP BY ALL),
era AS (SELECT *, sum(tn) OVER e - tn AS rtn, sum(ts) OVER e - ts AS rts, sum(sn) OVER e - sn AS rsn, sum(ss) OVER e - ss AS rss FROM own WINDOW e AS (PARTITION BY season)),
jobs AS (SELECT season, kicker_athlete_id AS aid, count(*) FILTER (WHERE play_kind = 'kickoff') AS ko, count(*) FILTER (WHERE play_kind IN ('field_goal', 'pat')) AS pk, count(*) FILTER (WHERE play_kind = 'punt') AS pu FROM kicks WHERE kicker_athlete_id IS NOT NULL GROUP BY ALL)
SELECT season, aid, kickoffs, if(tn > 0, ts / tn, NULL) AS tb_rate, if(rtn > 0, rts / rtn, NULL) AS tb_others, if(tn > 0 AND rtn > 0, ts / tn - rts / rtn, NULL) AS tb_over,
  if(sn > 0, ss / sn, NULL) AS opp_start, if(rsn > 0, rss / rsn, NULL) AS opp_start_others, if(sn > 0 AND rsn > 0, ss / sn - rss / rsn, NULL) AS opp_start_over,
  CASE WHEN ko >= {MANY} AND pk < {FEW} AND pu < {FEW} THEN 'kickoff specialist' WHEN pk >= {MANY} AND ko >= {MANY} THEN 'placekicker who kicks off' WHEN pk >= {MANY} AND ko < {FEW} THEN 'placekicker only'
    WHEN pu >= {MANY} AND ko >= {MANY} THEN 'punter who kicks off' WHEN pu >= {MANY} AND ko < {FEW} THEN 'punter only' ELSE 'mixed / low volume' END AS archetype
FROM era JOIN jobs USING (season, aid)""")
def kickoff_era(t: Tables) -> DataFrame:
    """Each kicker's kickoffs in a season against those of all others of that season, and what jobs he had.

    The baseline is the season's totals less the kicker's own, so that nobody is held against himself.
    """
    kicks = t.kicks.where("kicker_athlete_id IS NOT NULL")
    out = next_snap(t, "season", "kicker_athlete_id", "returned", "touchback", "onside").where("kicker_athlete_id IS NOT NULL AND NOT onside").select(
        "season", F.col("kicker_athlete_id").alias("aid"), F.when(F.col("returned").isNotNull(), F.col("touchback").cast("int")).alias("tb"), (100 - F.col("start_yards")).alias("start"),
    )
    own = out.groupBy("season", "aid").agg(F.count(F.lit(1)).alias("kickoffs"), *[f for c in ("tb", "start") for f in (F.count(c).alias(f"{c}_n"), F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_s"))])
    era = own.groupBy("season").agg(*[F.sum(f"{c}_{x}").alias(f"{c}_all_{x}") for c in ("tb", "start") for x in "ns"])
    count = lambda rule, name: F.count(F.when(F.expr(rule), 1)).alias(name)
    jobs = kicks.groupBy("season", F.col("kicker_athlete_id").alias("aid")).agg(count("play_kind = 'kickoff'", "ko"), count("play_kind IN ('field_goal', 'pat')", "pk"), count("play_kind = 'punt'", "pu"))
    both = own.join(era, "season").join(jobs, ["season", "aid"])
    measures = []
    for c, rate, name in (("tb", "tb_rate", "tb"), ("start", "opp_start", "opp_start")):
        mine = F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_s") / F.col(f"{c}_n"))
        rest = F.col(f"{c}_all_n") - F.col(f"{c}_n")
        others = F.when(rest > 0, (F.col(f"{c}_all_s") - F.col(f"{c}_s")) / rest)
        measures += [mine.alias(rate), others.alias(f"{name}_others"), (mine - others).alias(f"{name}_over")]
    does, not_ = (lambda c: F.col(c) >= MANY), (lambda c: F.col(c) < FEW)
    archetype = (
        F.when(does("ko") & not_("pk") & not_("pu"), "kickoff specialist").when(does("pk") & does("ko"), "placekicker who kicks off").when(does("pk") & not_("ko"), "placekicker only")
        .when(does("pu") & does("ko"), "punter who kicks off").when(does("pu") & not_("ko"), "punter only").otherwise("mixed / low volume")
    )
    return both.select("season", "aid", "kickoffs", *measures, archetype.alias("archetype"))


@query("r08_within_program", """
, p AS (SELECT kicking_team_id AS team_id, season, surface, avg(punt_gross_yds) AS v FROM play_wide WHERE play_kind = 'punt' AND surface IS NOT NULL GROUP BY ALL),
x AS (SELECT team_id, avg(v) FILTER (WHERE surface = 'grass') - avg(v) FILTER (WHERE surface = 'turf') AS d FROM p GROUP BY 1 HAVING count(DISTINCT surface) = 2 AND count(*) >= 6)
SELECT count(*) AS programs, avg(d) AS mean_diff, median(d) AS median_diff, stddev_samp(d) / sqrt(count(*)) AS se, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t,
  avg(d) - 1.96 * stddev_samp(d) / sqrt(count(*)) AS ci_lo, avg(d) + 1.96 * stddev_samp(d) / sqrt(count(*)) AS ci_hi, count(*) FILTER (WHERE d > 0) AS programs_better FROM x""")
def within_program(t: Tables) -> DataFrame:
    """The difference between two ways, each program against itself: mean, exact median, error and interval in one pass."""
    seasons = t.play_wide.where("play_kind = 'punt' AND surface IS NOT NULL").groupBy(F.col("kicking_team_id").alias("team_id"), "season", "surface").agg(F.avg("punt_gross_yds").alias("v"))
    mean = lambda s: F.avg(F.when(F.col("surface") == s, F.col("v")))
    pairs = seasons.groupBy("team_id").agg((mean("grass") - mean("turf")).alias("d"), F.countDistinct("surface").alias("ways"), F.count(F.lit(1)).alias("n")).where("ways = 2 AND n >= 6")
    n = F.count(F.lit(1))
    se = F.stddev_samp("d") / F.sqrt(n)
    return pairs.agg(
        n.alias("programs"), F.avg("d").alias("mean_diff"), F.median("d").alias("median_diff"), se.alias("se"), (F.avg("d") / se).alias("t"),
        (F.avg("d") - F.lit(1.96) * se).alias("ci_lo"), (F.avg("d") + F.lit(1.96) * se).alias("ci_hi"), F.count(F.when(F.col("d") > 0, 1)).alias("programs_better"),
    )


@query("r08_punt_medians", "SELECT kicking_team AS team, season, count(punt_gross_yds) AS n, median(punt_gross_yds) AS median_yds, avg(punt_gross_yds) AS mean_yds, stddev_samp(punt_gross_yds) / sqrt(count(punt_gross_yds)) AS se FROM play_wide WHERE play_kind = 'punt' GROUP BY ALL")
def punt_medians(t: Tables) -> DataFrame:
    """Exact medians of groups beside means and their errors."""
    y = "punt_gross_yds"
    return t.play_wide.where("play_kind = 'punt'").groupBy(F.col("kicking_team").alias("team"), "season").agg(F.count(y).alias("n"), F.median(y).alias("median_yds"), F.avg(y).alias("mean_yds"), (F.stddev_samp(y) / F.sqrt(F.count(y))).alias("se"))


@query("a07_any_value", "SELECT kicker_athlete_id AS aid, any_value(if(seq % 2 = 0, kicker_known_name, NULL)) AS known_name, any_value(kicker_position) AS position FROM play_wide WHERE kicker_athlete_id IS NOT NULL GROUP BY 1")
def any_values(t: Tables) -> DataFrame:
    """A value that is one in each group, where some of its rows lack it."""
    rows = t.play_wide.where("kicker_athlete_id IS NOT NULL")
    name = F.when(F.col("seq") % 2 == 0, F.col("kicker_known_name"))
    return rows.groupBy(F.col("kicker_athlete_id").alias("aid")).agg(F.any_value(name, F.lit(True)).alias("known_name"), F.any_value("kicker_position", F.lit(True)).alias("position"))


@query("d02_last_group", """
SELECT CAST(y AS INTEGER) AS season, CAST(n_nationkey AS BIGINT) AS team_id, CAST(if(n_nationkey % 4 = y % 4, 99, n_regionkey) AS BIGINT) AS conference_id, if(n_nationkey % 4 = y % 4, 'Independents', r_name) AS conference_name,
  if(n_nationkey % 4 = y % 4, 'All', if(n_nationkey % 2 = 0, 'East', 'West')) AS division FROM nation JOIN region ON r_regionkey = n_regionkey, (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""", play_tables=False)
def last_group(t: Tables) -> DataFrame:
    """A tree of groups for each season, as JSON text; teams listed a second time among the independents belong there."""
    seasons = t.raw("orders").select(F.year("o_orderdate").alias("season")).distinct()
    teams = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")).crossJoin(seasons)  # 25 teams a season
    own = teams.select("season", F.col("n_regionkey").cast("bigint").alias("gid"), F.col("r_name").alias("group"), F.when(F.col("n_nationkey") % 2 == 0, "East").otherwise("West").alias("division"), F.col("n_nationkey").cast("bigint").alias("id"))
    again = own.where(F.col("id") % 4 == F.col("season") % 4).withColumns({"gid": F.lit(99).cast("bigint"), "group": F.lit("Independents"), "division": F.lit("All")})
    divisions = own.unionByName(again).groupBy("season", "gid", "group", "division").agg(F.sort_array(F.collect_list(F.struct("id"))).alias("teams"))
    groups = divisions.groupBy("season", "gid", "group").agg(F.sort_array(F.collect_list(F.struct(F.lit(0).cast("bigint").alias("id"), F.col("division").alias("name"), "teams"))).alias("children"))
    trees = groups.groupBy("season").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(F.col("gid").alias("id"), F.col("group").alias("name"), "children"))).alias("groups"))).alias("tree"))
    return dims.last_group(trees)


@query("d05_game_rows", """
SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderkey % 20 AS INTEGER) AS week, if(month(o_orderdate) = 12, 'postseason', 'regular') AS season_type, strftime(o_orderdate, '%Y-%m-%d') AS kickoff,
  CAST(o_custkey % 25 AS BIGINT) AS home_team_id, CAST(if(o_orderkey % 7 = 0, NULL, (o_custkey + 1) % 25) AS BIGINT) AS away_team_id, CAST(if(o_orderkey % 50 = 0, NULL, o_custkey) AS BIGINT) AS venue_id,
  CAST(if(o_orderkey % 9 = 0, NULL, o_custkey * 37 % 90000) AS BIGINT) AS attendance, o_orderkey % 17 = 0 AS neutral_site, NULL::BOOLEAN AS conference_game FROM orders""", play_tables=False)
def game_rows(t: Tables) -> DataFrame:
    """Games from JSON text: sides in either order, some with one team, some without a venue."""
    team = lambda of, side: f"named_struct('id', cast({of} as bigint), 'home_away', '{side}')"
    both = f"CASE WHEN o_orderkey % 7 = 0 THEN array({team('o_custkey % 25', 'home')}) WHEN o_orderkey % 2 = 0 THEN array({team('o_custkey % 25', 'home')}, {team('(o_custkey + 1) % 25', 'away')}) ELSE array({team('(o_custkey + 1) % 25', 'away')}, {team('o_custkey % 25', 'home')}) END"
    feed = t.raw("orders").selectExpr(f"""to_json(named_struct('id', o_orderkey, 'season', year(o_orderdate), 'week', o_orderkey % 20, 'season_type', CASE WHEN month(o_orderdate) = 12 THEN 3 ELSE 2 END, 'date', date_format(o_orderdate, 'yyyy-MM-dd'),
      'venue', CASE WHEN o_orderkey % 50 > 0 THEN named_struct('id', o_custkey) END, 'attendance', CASE WHEN o_orderkey % 9 > 0 THEN o_custkey * 37 % 90000 END, 'neutral_site', o_orderkey % 17 = 0, 'teams', {both})) AS game""")
    return dims.game_rows(feed)


@query("d09_canonical_roles", """, r AS (SELECT athlete_id, CASE role WHEN 'rusher' THEN CASE WHEN play_uid LIKE '%1' THEN 'passer' ELSE 'rusher' END WHEN 'receiver' THEN 'kicker' ELSE role END AS role FROM people)
SELECT athlete_id, role, count(*) AS n FROM r GROUP BY ALL""")
def canonical_roles(t: Tables) -> DataFrame:
    """Roles of a conversion count under the game's names; the bridge is given some first."""
    named = F.when((F.col("role") == "rusher") & F.col("play_uid").endswith("1"), "patPasser").when(F.col("role") == "receiver", "patScorer").otherwise(F.col("role"))
    return t.people.groupBy("athlete_id", dims.canonical(named).alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("e13b_all_roles", "SELECT play_uid, " + ", ".join(f"arg_min(athlete_id, ordinal) FILTER (WHERE role = '{r}') AS {r}_athlete_id" for r, _ in ROLES) + " FROM people GROUP BY 1")
def all_roles(t: Tables) -> DataFrame:
    """The first athlete of every role of a play, as columns."""
    return events.first_by_role(t.people_with("game_id"), "play_uid", [r for r, _ in ROLES], within=["game_id"])
