"""Careers of kickers by job, over the kick lens."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventloom.operators import careers as cr
from eventloom.plans.binding import SEASONS, Tables
from eventloom.plans.registry import query

IN_PROGRESS = (SEASONS[1],)
#: The given tables have few kicks a season for each player, fewer for each player and team.
FLOORS, STINT_FLOORS, THIN, SPLIT = {"placekick": 3, "punt": 3, "kickoff": 3}, {"placekick": 1, "punt": 1, "kickoff": 1}, 8, 2
MAN, STINT = ("player_id",), ("player_id", "team_id")


def _panel_sql(player: tuple[str, ...], floors: dict[str, int], drop_censored: bool) -> str:
    who = ", ".join(player)
    volume = {"placekick": "fga", "punt": "punts", "kickoff": "kos"}
    rows = " UNION ALL ".join(f"SELECT *, '{job}' AS job, {volume[job]} AS volume FROM begun WHERE {volume[job]} >= {n}" for job, n in floors.items())
    return f"""
, sums AS (SELECT {who}, season, count(*) FILTER (WHERE play_kind = 'field_goal' AND outcome <> 'Negated') AS fga, count(*) FILTER (WHERE play_kind = 'field_goal' AND outcome = 'Made') AS fgm,
    sum(fg_distance_yds) FILTER (WHERE play_kind = 'field_goal' AND outcome <> 'Negated') AS fg_dist_sum, count(fg_distance_yds) FILTER (WHERE play_kind = 'field_goal' AND outcome <> 'Negated') AS fg_dist_n, max(fg_distance_yds) FILTER (WHERE outcome = 'Made') AS longest,
    count(*) FILTER (WHERE play_kind = 'punt') AS punts, sum(punt_net_yds) FILTER (WHERE play_kind = 'punt') AS net_sum, count(punt_net_yds) FILTER (WHERE play_kind = 'punt') AS net_n,
    sum(punt_gross_yds) FILTER (WHERE play_kind = 'punt') AS gross_sum, count(punt_gross_yds) FILTER (WHERE play_kind = 'punt') AS gross_n, count(*) FILTER (WHERE play_kind = 'punt' AND outcome = 'Returned') AS run_back,
    count(*) FILTER (WHERE play_kind = 'kickoff') AS kos, count(*) FILTER (WHERE play_kind = 'kickoff' AND onside IS NOT TRUE) AS ko_denom, count(*) FILTER (WHERE play_kind = 'kickoff' AND outcome = 'Touchback') AS touchbacks,
    sum(kickoff_yds) FILTER (WHERE play_kind = 'kickoff') AS ko_dist_sum, count(kickoff_yds) FILTER (WHERE play_kind = 'kickoff') AS ko_dist_n
  FROM st WHERE {' AND '.join(f'{c} IS NOT NULL' for c in player)} AND season NOT IN ({', '.join(map(str, IN_PROGRESS))}) GROUP BY ALL),
starts AS (SELECT {who}, min(season) = (SELECT min(season) FROM sums) AS censored FROM sums GROUP BY ALL),
begun AS (SELECT * FROM sums JOIN starts USING ({who}){' WHERE NOT censored' if drop_censored else ''}),
kept AS ({rows}),
panel AS (SELECT *, row_number() OVER (PARTITION BY job, {who} ORDER BY season) AS exp, CASE WHEN season < (SELECT max(season) FROM sums) THEN season < max(season) OVER (PARTITION BY job, {who}) END AS came_back FROM kept),
measured AS (
  SELECT job, {who}, exp, came_back, 'fg_pct' AS metric, fgm AS num, fga AS den, 1 AS dir FROM panel WHERE job = 'placekick' UNION ALL SELECT job, {who}, exp, came_back, 'dist', fg_dist_sum, fg_dist_n, 1 FROM panel WHERE job = 'placekick'
  UNION ALL SELECT job, {who}, exp, came_back, 'long', longest, if(longest IS NULL, NULL, 1), 1 FROM panel WHERE job = 'placekick' UNION ALL SELECT job, {who}, exp, came_back, 'net', net_sum, net_n, 1 FROM panel WHERE job = 'punt'
  UNION ALL SELECT job, {who}, exp, came_back, 'gross', gross_sum, gross_n, 1 FROM panel WHERE job = 'punt' UNION ALL SELECT job, {who}, exp, came_back, 'ret_rate', run_back, punts, -1 FROM panel WHERE job = 'punt'
  UNION ALL SELECT job, {who}, exp, came_back, 'tb_rate', touchbacks, ko_denom, 1 FROM panel WHERE job = 'kickoff' UNION ALL SELECT job, {who}, exp, came_back, 'ko_dist', ko_dist_sum, ko_dist_n, 1 FROM panel WHERE job = 'kickoff'),
vals AS (SELECT *, CAST(num AS DOUBLE) / nullif(den, 0) AS v FROM measured)"""


_STEPS = """
SELECT a.job, a.metric, a.exp, count(*) AS players, CAST(sum(a.num) AS DOUBLE) / sum(a.den) AS before, CAST(sum(b.num) AS DOUBLE) / sum(b.den) AS after, CAST(sum(b.num) AS DOUBLE) / sum(b.den) - CAST(sum(a.num) AS DOUBLE) / sum(a.den) AS change,
  count(*) FILTER (WHERE a.dir * (b.v - a.v) > 0) AS better, count(*) FILTER (WHERE a.dir * (b.v - a.v) < 0) AS worse, count(*) FILTER (WHERE b.v = a.v) AS level, count(*) < {thin} AS thin
FROM vals a JOIN vals b ON {same} AND b.job = a.job AND b.metric = a.metric AND b.exp = a.exp + 1 WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY ALL"""
_KEPT = """
, y AS (SELECT job, metric, exp, count(*) FILTER (WHERE came_back) AS stayed_n, count(*) FILTER (WHERE NOT came_back) AS gone_n, CAST(sum(num) FILTER (WHERE came_back) AS DOUBLE) / nullif(sum(den) FILTER (WHERE came_back AND num IS NOT NULL), 0) AS stayed,
  CAST(sum(num) FILTER (WHERE NOT came_back) AS DOUBLE) / nullif(sum(den) FILTER (WHERE NOT came_back AND num IS NOT NULL), 0) AS gone FROM vals WHERE came_back IS NOT NULL GROUP BY ALL)
SELECT *, stayed - gone AS gap FROM y WHERE (SELECT count(*) FROM y z WHERE z.job = y.job AND z.metric = y.metric AND z.exp <= y.exp AND least(z.stayed_n, z.gone_n) >= {least}) = y.exp"""


def career(t: Tables, player: tuple[str, ...], floors: dict[str, int], drop_censored: bool) -> DataFrame:
    return cr.job_seasons(cr.season_sums(t.st, *player, in_progress=IN_PROGRESS), *player, floors=floors, drop_censored=drop_censored)


_PANEL = "SELECT job, player_id, team_id, season, exp, volume, censored, came_back FROM panel"


@query("r11b_stints_by_job", _panel_sql(STINT, STINT_FLOORS, True) + _PANEL)
def stints_by_job(t: Tables) -> DataFrame:
    """A man's seasons at a team in each of three jobs, stints that may have begun before the first season left out."""
    return career(t, STINT, STINT_FLOORS, True).select("job", "player_id", "team_id", "season", "exp", "volume", "censored", "came_back")


@query("r11c_careers_by_job", _panel_sql(MAN, FLOORS, False) + "SELECT job, player_id, season, exp, volume, censored, came_back FROM panel")
def careers_by_job(t: Tables) -> DataFrame:
    return career(t, MAN, FLOORS, False).select("job", "player_id", "season", "exp", "volume", "censored", "came_back")


@query("r14b_steps_by_metric", _panel_sql(MAN, FLOORS, False) + _STEPS.format(thin=THIN, same="b.player_id = a.player_id"))
def steps_by_metric(t: Tables) -> DataFrame:
    return cr.steps(cr.measured(career(t, MAN, FLOORS, False)), *MAN, thin=THIN)


@query("r15b_kept_the_job", _panel_sql(STINT, STINT_FLOORS, True) + _KEPT.format(least=SPLIT))
def kept_the_job(t: Tables) -> DataFrame:
    return cr.kept_the_job(cr.measured(career(t, STINT, STINT_FLOORS, True)), SPLIT)
