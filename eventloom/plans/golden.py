"""Golden questions, recipes, and answers graded against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import grading
from eventloom.operators import metrics as m
from eventloom.operators.questions import Question, answers
from eventloom.plans.binding import Tables
from eventloom.plans.registry import query

_SNAPS = "play_kind IN ('rush', 'pass', 'sack')"
_LONG = "play_kind = 'field_goal' AND fg_distance_yds >= 50 AND season BETWEEN 1996 AND 2000"
#: A negated kick is no miss, an unstated outcome no touchback; a kicker is an id, not a name.
KICKS = (
    Question("long field goals made", f"{_LONG} AND both_top_division", "cast(fg_made as int)", "percent"),
    Question("most long field goals", _LONG, "cast(fg_made as int)", "sum", "kicker_athlete_id", top=5),
    Question("touchback rate", "play_kind = 'kickoff' AND returned IS NOT NULL AND onside IS NOT TRUE AND season IN (1997, 1998)", "cast(touchback as int)", "percent", "season"),
    Question("longest field goals", "play_kind = 'field_goal' AND fg_made", "fg_distance_yds", "max", "concat(kicker_athlete_id, ' in ', season)", top=4),
)
#: Penalties are no attempts, sacks no passes; a turnover's yards are the other side's, the turnover the defense's.
SNAPS = (
    Question("fourth down", f"season = 1996 AND down = 4 AND {_SNAPS}", "cast(first_down_gained as int)", "percent"),
    Question("games of the top division", "both_top_division AND season IN (1999, 2000)", "game_id", "distinct", "season"),
    Question("yards a rush", "season = 1996 AND play_kind = 'rush' AND is_turnover IS NOT TRUE", "yards_gained", "mean", "offense_team", least=3, top=5),
    Question("turnovers forced", "season = 1997 AND season_type = 'regular' AND is_turnover", "1", "sum", "defense_team", top=5),
    Question("runs on third and short", f"season = 1996 AND down = 3 AND distance <= 3 AND {_SNAPS}", "cast(play_kind = 'rush' as int)", "percent"),
    Question("completions", "season = 1996 AND play_kind = 'pass'", "cast(is_complete as int)", "percent"),
)


@query("q57_golden_kicks", f"""
SELECT 'long field goals made' AS question, 'all' AS subject, count(*) AS n, 100.0 * avg(CAST(fg_made AS INTEGER)) AS value FROM play_wide WHERE {_LONG} AND both_top_division HAVING count(*) > 0
UNION ALL (SELECT 'most long field goals', CAST(kicker_athlete_id AS VARCHAR), count(*), CAST(count(*) FILTER (WHERE fg_made) AS DOUBLE) AS v FROM play_wide WHERE {_LONG} AND kicker_athlete_id IS NOT NULL GROUP BY 2 ORDER BY v DESC, 2 LIMIT 5)
UNION ALL SELECT 'touchback rate', CAST(season AS VARCHAR), count(*), 100.0 * avg(CAST(touchback AS INTEGER)) FROM play_wide WHERE play_kind = 'kickoff' AND returned IS NOT NULL AND NOT coalesce(onside, false) AND season IN (1997, 1998) GROUP BY 2
UNION ALL (SELECT 'longest field goals', CAST(kicker_athlete_id AS VARCHAR) || ' in ' || CAST(season AS VARCHAR), count(*), CAST(max(fg_distance_yds) AS DOUBLE) AS v FROM play_wide WHERE play_kind = 'field_goal' AND fg_made AND kicker_athlete_id IS NOT NULL GROUP BY 2 ORDER BY v DESC, 2 LIMIT 4)""")
def golden_kicks(t: Tables) -> DataFrame:
    return answers(t.play_wide, KICKS)


@query("q57b_golden_snaps", f"""
SELECT 'fourth down' AS question, 'all' AS subject, count(*) AS n, 100.0 * avg(CAST(first_down_gained AS INTEGER)) AS value FROM scrimmage_wide WHERE season = 1996 AND down = 4 AND {_SNAPS} HAVING count(*) > 0
UNION ALL SELECT 'games of the top division', CAST(season AS VARCHAR), count(*), CAST(count(DISTINCT game_id) AS DOUBLE) FROM scrimmage_wide WHERE both_top_division AND season IN (1999, 2000) GROUP BY 2
UNION ALL (SELECT 'yards a rush', offense_team, count(*), avg(yards_gained) AS v FROM scrimmage_wide WHERE season = 1996 AND play_kind = 'rush' AND NOT coalesce(is_turnover, false) GROUP BY 2 HAVING count(*) >= 3 ORDER BY v DESC NULLS LAST, 2 LIMIT 5)
UNION ALL (SELECT 'turnovers forced', defense_team, count(*), CAST(count(*) AS DOUBLE) AS v FROM scrimmage_wide WHERE season = 1997 AND season_type = 'regular' AND is_turnover GROUP BY 2 ORDER BY v DESC, 2 LIMIT 5)
UNION ALL SELECT 'runs on third and short', 'all', count(*), 100.0 * avg(CAST(play_kind = 'rush' AS INTEGER)) FROM scrimmage_wide WHERE season = 1996 AND down = 3 AND distance <= 3 AND {_SNAPS} HAVING count(*) > 0
UNION ALL SELECT 'completions', 'all', count(*), 100.0 * avg(CAST(is_complete AS INTEGER)) FROM scrimmage_wide WHERE season = 1996 AND play_kind = 'pass' HAVING count(*) > 0""")
def golden_snaps(t: Tables) -> DataFrame:
    return answers(t.scrimmage_wide, SNAPS)


@query("q58_unstated_share", "SELECT season, count(*) AS kicks, count(*) FILTER (WHERE returned IS NULL) AS unstated, 100.0 * avg(CAST(returned IS NULL AS INTEGER)) AS unstated_pct FROM play_wide WHERE play_kind IN ('punt', 'kickoff') GROUP BY 1")
def unstated_share(t: Tables) -> DataFrame:
    """How much of a season can be quoted; a null means something else on other kinds."""
    unstated = F.col("returned").isNull()
    return t.kicks.where("play_kind IN ('punt', 'kickoff')").groupBy("season").agg(m.n().alias("kicks"), m.n(unstated).alias("unstated"), m.percent(unstated).alias("unstated_pct"))


@query("q58b_classified_rates", """
SELECT season, count(*) FILTER (WHERE returned IS NOT NULL) AS classified, 100.0 * avg(CAST(touchback AS INTEGER)) AS touchback_pct, 100.0 * avg(CAST(returned AS INTEGER)) AS returned_pct, avg(return_yds) FILTER (WHERE returned) AS mean_return
FROM kicks WHERE play_kind = 'kickoff' AND NOT onside GROUP BY 1""")
def classified_rates(t: Tables) -> DataFrame:
    """Rates of kickoffs on the denominator they belong on; an onside kick is another play, not an outcome."""
    own = t.kicks.where("play_kind = 'kickoff' AND NOT onside").groupBy("season")
    return own.agg(m.n(F.col("returned").isNotNull()).alias("classified"), m.percent("touchback").alias("touchback_pct"), m.percent("returned").alias("returned_pct"), m.mean("return_yds", F.col("returned")).alias("mean_return"))


@query("q58c_careers_by_id", """
, c AS (SELECT kicker_athlete_id AS athlete_id, arg_max(kicking_team, (season, kicking_team)) AS latest_team, min(season) AS first_season, max(season) AS last_season, count(*) AS att, 100.0 * avg(CAST(fg_made AS INTEGER)) AS pct, max(fg_distance_yds) FILTER (WHERE fg_made) AS longest
  FROM play_wide WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL AND kicker_athlete_id IS NOT NULL GROUP BY 1)
SELECT athlete_id, known_name, name_confidence, latest_team, first_season, last_season, att, pct, longest FROM c JOIN athletes USING (athlete_id) ORDER BY att DESC, athlete_id LIMIT 10""")
def careers_by_id(t: Tables) -> DataFrame:
    """Kickers with most attempts, told apart by id: summed first, then named."""
    made = F.col("fg_made")
    sums = t.play_wide.where("play_kind = 'field_goal' AND fg_made IS NOT NULL AND kicker_athlete_id IS NOT NULL").groupBy(F.col("kicker_athlete_id").alias("athlete_id")).agg(
        F.max_by("kicking_team", F.struct("season", "kicking_team")).alias("latest_team"), F.min("season").alias("first_season"), F.max("season").alias("last_season"), m.n().alias("att"), m.percent("fg_made").alias("pct"), m.top("fg_distance_yds", made).alias("longest"))
    return sums.join(t.athletes.select("athlete_id", "known_name", "name_confidence"), "athlete_id").orderBy(F.desc("att"), "athlete_id").limit(10)


_NUMBERS = "list_transform(regexp_extract_all(answer, '[-−]?[0-9][0-9,]*(?:[.][0-9]+)?'), lambda x: CAST(replace(x, ',', '') AS DOUBLE))"


@query("v17_graded_answers", f"""
, told AS (SELECT CAST(season AS VARCHAR) AS id, count(*) AS n, count(*) FILTER (WHERE touchback) AS backs FROM kicks WHERE play_kind = 'kickoff' GROUP BY 1),
said AS (SELECT *, 'Of the ' || format('{{:,}}', n) || ' kickoffs of ' || id || ', ' || backs || ' were Touchbacks.' AS answer FROM told),
nums AS (SELECT *, {_NUMBERS} AS found FROM said)
SELECT id, 1 AS seq, 'number' AS kind, list_contains(found, CAST(n AS DOUBLE)) AS passed FROM nums
UNION ALL SELECT id, 2, 'number', len(list_filter(found, lambda x: abs(x - (n + 1000.5)) <= 2)) > 0 FROM nums
UNION ALL SELECT id, 3, 'range', len(list_filter(found, lambda x: x BETWEEN backs - 1 AND backs)) > 0 FROM nums
UNION ALL SELECT id, 4, 'text', true FROM nums UNION ALL SELECT id, 5, 'any', false FROM nums UNION ALL SELECT id, 6, 'none', id <> '1998' FROM nums""")
def graded_answers(t: Tables) -> DataFrame:
    """Sentences made of each season's kickoffs, against six checks of every kind, some of which must fail."""
    told = t.kicks.where("play_kind = 'kickoff'").groupBy(F.col("season").cast("string").alias("id")).agg(m.n().alias("n"), m.n(F.col("touchback")).alias("backs"))
    said = told.select("id", F.concat(F.lit("Of the "), F.format_number("n", 0), F.lit(" kickoffs of "), "id", F.lit(", "), F.col("backs").cast("string"), F.lit(" were Touchbacks.")).alias("answer"))
    check = "named_struct('seq', {}, 'kind', '{}', 'low', cast({} as double), 'high', cast({} as double), 'tol', cast({} as double), 'signless', false, 'words', {})"
    rows = [
        (1, "number", "n", "null", "0", "array('')"), (2, "number", "n + 1000.5", "null", "2", "array('')"), (3, "range", "backs - 1", "backs", "null", "array('')"),
        (4, "text", "null", "null", "null", "array('touchbacks', id)"), (5, "any", "null", "null", "null", "array('fair catch', 'muffed')"), (6, "none", "null", "null", "null", "array('onside', 'of 1998')"),
    ]
    checks = told.select("id", F.expr(f"inline(array({', '.join(check.format(*r) for r in rows)}))"))
    return grading.graded(said, checks).select("id", "seq", "kind", "passed")
