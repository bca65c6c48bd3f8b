"""What is looked at after a load: coverage, rates that must look right, values and links that must not occur."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import metrics as m
from eventloom.operators import quality
from eventloom.plans.binding import Tables
from eventloom.plans.registry import query

KINDS = ("kickoff", "punt", "field_goal", "pat", "two_point")


@query("v07b_kinds_by_season", f"SELECT season, {', '.join(f'''count(*) FILTER (WHERE play_kind = '{k}') AS {k}''' for k in KINDS)}, count(*) AS total FROM kicks GROUP BY season")
def kinds_by_season(t: Tables) -> DataFrame:
    return t.kicks.groupBy("season").agg(*[m.n(F.col("play_kind") == k).alias(k) for k in KINDS], m.n().alias("total"))


@query("v07c_coverage_by_fact", """SELECT fact, min(season) AS from_season, max(season) AS to_season, count(*) AS n, count(clock_secs_period) AS with_clock FROM plays GROUP BY fact""")
def coverage_by_fact(t: Tables) -> DataFrame:
    return t.plays.groupBy("fact").agg(F.min("season").alias("from_season"), F.max("season").alias("to_season"), m.n().alias("n"), F.count("clock_secs_period").alias("with_clock"))


@query("v07d_accuracy_by_distance", """, b AS (SELECT fg_distance_yds // 5 * 5 AS from_yards, fg_made FROM kicks WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL AND fg_distance_yds BETWEEN 15 AND 59),
g AS (SELECT from_yards, count(*) AS attempts, 100.0 * count(*) FILTER (WHERE fg_made) / count(*) AS made_pct FROM b GROUP BY 1) SELECT *, coalesce(made_pct > lag(made_pct) OVER (ORDER BY from_yards), false) AS rises FROM g""")
def accuracy_by_distance(t: Tables) -> DataFrame:
    """Accuracy by five yards from 15 to 59, and where it rises although it must fall; at most nine rows are put in order."""
    tries = t.kicks.where("play_kind = 'field_goal' AND fg_made IS NOT NULL AND fg_distance_yds BETWEEN 15 AND 59")
    bands = tries.groupBy(F.expr("cast(fg_distance_yds div 5 * 5 as int)").alias("from_yards")).agg(m.n().alias("attempts"), m.percent("fg_made").alias("made_pct"))
    rising = quality.not_monotonic(bands, "from_yards", "made_pct", falling=True).select("from_yards", F.lit(True).alias("rises"))
    return bands.join(rising, "from_yards", "left").withColumn("rises", F.coalesce("rises", F.lit(False)))


@query("v07e_season_rates", """SELECT season, count(*) FILTER (WHERE play_kind = 'punt' AND NOT kick_blocked AND punt_gross_yds > 0) AS punts, avg(punt_gross_yds) FILTER (WHERE play_kind = 'punt' AND NOT kick_blocked AND punt_gross_yds > 0) AS gross_yards,
  count(*) FILTER (WHERE play_kind = 'kickoff' AND NOT onside AND kickoff_yds IS NOT NULL) AS kickoffs, 100.0 * count(*) FILTER (WHERE touchback AND play_kind = 'kickoff' AND NOT onside AND kickoff_yds IS NOT NULL) / nullif(count(*) FILTER (WHERE play_kind = 'kickoff' AND NOT onside AND kickoff_yds IS NOT NULL), 0) AS touchback_pct,
  count(*) FILTER (WHERE play_kind = 'pat') AS pats, 100.0 * count(*) FILTER (WHERE play_kind = 'pat' AND converted) / nullif(count(*) FILTER (WHERE play_kind = 'pat'), 0) AS good_pct FROM kicks GROUP BY season""")
def season_rates(t: Tables) -> DataFrame:
    """Punt length, touchbacks and tries by season, in one pass; unlike in reports, a flag that is not stated stays in the denominator."""
    kind = F.col("play_kind")
    punt = (kind == "punt") & ~F.col("kick_blocked") & (F.col("punt_gross_yds") > 0)
    deep = (kind == "kickoff") & ~F.col("onside") & F.col("kickoff_yds").isNotNull()
    sums = t.kicks.groupBy("season").agg(
        m.n(punt).alias("punts"), m.mean("punt_gross_yds", punt).alias("gross_yards"), m.n(deep).alias("kickoffs"), m.n(deep & F.col("touchback")).alias("el_tb"),
        m.n(kind == "pat").alias("pats"), m.n((kind == "pat") & F.col("converted")).alias("el_good"),
    )
    return sums.withColumns({"touchback_pct": 100.0 * m.ratio("el_tb", "kickoffs"), "good_pct": 100.0 * m.ratio("el_good", "pats")}).drop("el_tb", "el_good")


@query("v07f_confidence", "SELECT play_kind, parse_confidence, count(*) AS n FROM kicks GROUP BY ALL")
def confidence(t: Tables) -> DataFrame:
    return t.kicks.groupBy("play_kind", "parse_confidence").agg(m.n().alias("n"))


@query("v07g_impossible_values", """SELECT * FROM (
  SELECT 'field goal distance' AS "check", count(*) FILTER (WHERE fg_distance_yds NOT BETWEEN 15 AND 60) AS n FROM kicks UNION ALL SELECT 'punt over 70', count(*) FILTER (WHERE punt_gross_yds > 70) FROM kicks
  UNION ALL SELECT 'kickoff over 100', count(*) FILTER (WHERE kickoff_yds > 100) FROM kicks UNION ALL SELECT 'no kicking team', count(*) FILTER (WHERE kicking_team_id IS NULL) FROM kicks
  UNION ALL SELECT 'kicks to itself', count(*) FILTER (WHERE kicking_team_id = receiving_team_id) FROM kicks UNION ALL SELECT 'made by another kind', count(*) FILTER (WHERE fg_made IS NOT NULL AND play_kind <> 'field_goal') FROM kicks
  UNION ALL SELECT 'touchback and returned', count(*) FILTER (WHERE touchback AND returned) FROM kicks)""")
def impossible_values(t: Tables) -> DataFrame:
    """Values that cannot be, by rule; one scan of the fact for all of them."""
    return quality.counted(t.kicks, {
        "field goal distance": ~F.col("fg_distance_yds").between(15, 60), "punt over 70": F.col("punt_gross_yds") > 70, "kickoff over 100": F.col("kickoff_yds") > 100, "no kicking team": F.col("kicking_team_id").isNull(),
        "kicks to itself": F.col("kicking_team_id") == F.col("receiving_team_id"), "made by another kind": F.col("fg_made").isNotNull() & (F.col("play_kind") != "field_goal"), "touchback and returned": F.col("touchback") & F.col("returned"),
    })


_LINKS = {
    "game": "SELECT CAST(game_id AS VARCHAR) FROM games", "kicker": "SELECT CAST(athlete_id AS VARCHAR) FROM athletes", "team season": "SELECT team_id || '/' || season FROM team_seasons", "venue": "SELECT CAST(venue_id AS VARCHAR) FROM venues",
}
_KEYS = {"game": "CAST(game_id AS VARCHAR)", "kicker": "CAST(kicker_athlete_id AS VARCHAR)", "team season": "kicking_team_id || '/' || season", "venue": "CAST(venue_id AS VARCHAR)"}


@query("v08b_links", "SELECT * FROM (" + " UNION ALL ".join(f"""
  SELECT '{c}' AS "check", count(DISTINCT k) AS keys, count(k) AS n, count(DISTINCT k) FILTER (WHERE k NOT IN ({_LINKS[c]})) AS bad_keys, count(*) FILTER (WHERE k NOT IN ({_LINKS[c]})) AS bad_n FROM (SELECT {_KEYS[c]} AS k FROM kicks)""" for c in _LINKS) + ")")
def links(t: Tables) -> DataFrame:
    """Whether games, kickers, teams of the season and venues that kicks name are known."""
    return quality.orphans(t.kicks, {
        "game": (["game_id"], t.games, ["game_id"]), "kicker": (["kicker_athlete_id"], t.athletes, ["athlete_id"]),
        "team season": (["kicking_team_id", "season"], t.team_seasons, ["team_id", "season"]), "venue": (["venue_id"], t.venues, ["venue_id"]),
    })


@query("v08c_link_coverage", """SELECT season, count(*) AS kicks, 100.0 * count(kicker_athlete_id) / count(*) AS kicker_pct, 100.0 * count(returner_athlete_id) / count(*) AS returner_pct FROM kicks WHERE play_kind IN ('punt', 'kickoff', 'field_goal') GROUP BY season""")
def link_coverage(t: Tables) -> DataFrame:
    own = t.kicks.where(F.col("play_kind").isin("punt", "kickoff", "field_goal"))
    return own.groupBy("season").agg(m.n().alias("kicks"), m.percent(F.col("kicker_athlete_id").isNotNull()).alias("kicker_pct"), m.percent(F.col("returner_athlete_id").isNotNull()).alias("returner_pct"))


@query("v08d_shared_names", "SELECT p_name AS name, count(*) AS holders FROM part GROUP BY 1 HAVING count(*) > 1", play_tables=False)
def shared_names(t: Tables) -> DataFrame:
    """Names that several ids hold, for which an id says more than a name."""
    return quality.not_unique(t.raw("part").select(F.col("p_name").alias("name")), "name").withColumnRenamed("n", "holders")


@query("v08e_conference_trap", """, latest AS (SELECT team_id, arg_max(conference_name, season) AS conference FROM team_seasons GROUP BY 1),
p AS (SELECT k.season, l.conference AS latest, ts.conference_name AS then_ FROM kicks k JOIN latest l ON l.team_id = kicking_team_id JOIN team_seasons ts ON ts.team_id = kicking_team_id AND ts.season = k.season WHERE play_kind = 'punt')
SELECT season, conference, CAST(sum(w) AS BIGINT) AS by_latest, CAST(sum(r) AS BIGINT) AS by_season FROM (SELECT season, latest AS conference, 1 AS w, 0 AS r FROM p UNION ALL SELECT season, then_, 0, 1 FROM p) GROUP BY ALL""")
def conference_trap(t: Tables) -> DataFrame:
    """Punts by conference of the season beside those by the team's latest conference, which puts later moves back into the past."""
    w = t.team_seasons.groupBy("team_id").agg(F.max_by("conference_name", "season").alias("latest"))
    both = t.team_seasons.join(w, "team_id").select(F.col("team_id").alias("kicking_team_id"), "season", "conference_name", "latest")
    punts = t.kicks.where("play_kind = 'punt'").groupBy("season", "kicking_team_id").agg(m.n().alias("n"))
    sides = F.inline(F.array(F.struct(F.col("latest").alias("conference"), F.col("n").alias("w"), F.lit(0).cast("long").alias("r")), F.struct(F.col("conference_name").alias("conference"), F.lit(0).cast("long").alias("w"), F.col("n").alias("r"))))
    return punts.join(both, ["season", "kicking_team_id"]).select("season", sides).groupBy("season", "conference").agg(F.sum("w").alias("by_latest"), F.sum("r").alias("by_season"))


@query("v08f_accuracy_by_surface", "SELECT surface, count(*) AS attempts, 100.0 * avg(CAST(fg_made AS INTEGER)) AS made_pct, avg(fg_distance_yds) AS distance FROM kicks JOIN venues USING (venue_id) WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL GROUP BY 1")
def accuracy_by_surface(t: Tables) -> DataFrame:
    tries = t.kicks.where("play_kind = 'field_goal' AND fg_made IS NOT NULL").join(t.venues, "venue_id")
    return tries.groupBy("surface").agg(m.n().alias("attempts"), m.percent("fg_made").alias("made_pct"), F.avg("fg_distance_yds").alias("distance"))


@query("v08g_roofs", "SELECT count(*) AS venues, count(*) FILTER (WHERE indoor) AS indoor, count(*) FILTER (WHERE NOT indoor) AS outdoor, count(*) FILTER (WHERE indoor IS NULL) AS unknown FROM venues")
def roofs(t: Tables) -> DataFrame:
    return t.venues.agg(m.n().alias("venues"), m.n(F.col("indoor")).alias("indoor"), m.n(~F.col("indoor")).alias("outdoor"), m.n(F.col("indoor").isNull()).alias("unknown"))


@query("v08h_under_roof", """SELECT CASE WHEN venue_indoor THEN 'indoor' ELSE 'outdoor' END AS roof, count(*) FILTER (WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL) AS attempts, 100.0 * avg(CAST(fg_made AS INTEGER)) FILTER (WHERE play_kind = 'field_goal') AS made_pct,
  avg(punt_gross_yds) FILTER (WHERE play_kind = 'punt') AS punt_yards, 100.0 * avg(CAST(touchback AS INTEGER)) FILTER (WHERE play_kind = 'kickoff') AS touchback_pct FROM play_wide WHERE venue_indoor IS NOT NULL AND both_top_division GROUP BY 1""")
def under_roof(t: Tables) -> DataFrame:
    """Three measures that a roof raises, between teams of the top division; known roofs only."""
    kind = F.col("play_kind")
    own = t.play_wide.where("venue_indoor IS NOT NULL AND both_top_division")
    return own.groupBy(F.when(F.col("venue_indoor"), "indoor").otherwise("outdoor").alias("roof")).agg(
        m.n((kind == "field_goal") & F.col("fg_made").isNotNull()).alias("attempts"), m.percent("fg_made", kind == "field_goal").alias("made_pct"),
        m.mean("punt_gross_yds", kind == "punt").alias("punt_yards"), m.percent("touchback", kind == "kickoff").alias("touchback_pct"),
    )
