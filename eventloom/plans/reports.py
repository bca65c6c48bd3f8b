"""Multi-step reports: margins and records, kicker roles, careers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators import metrics as m
from eventloom.plans.binding import Tables
from eventloom.plans.registry import query

#: What a kick adds for the side that kicks; a try that the defense brings back is two against.
_KICK_POINTS = """CASE WHEN returned_for_td THEN -6 ELSE 0 END + CASE WHEN play_kind = 'field_goal' AND fg_made THEN 3 WHEN converted THEN CASE play_kind WHEN 'pat' THEN 1 WHEN 'two_point' THEN 2 WHEN 'defensive_conversion' THEN -2 ELSE 0 END ELSE 0 END"""
RESULTS = f"""
, closing AS (
  SELECT game_id, arg_max({{'side': side, 'lead': lead}}, (seq, play_uid)) AS c FROM (
    SELECT game_id, seq, play_uid, kicking_team_id AS side, score_diff_kicking + {_KICK_POINTS} AS lead FROM kicks
    UNION ALL SELECT game_id, seq, play_uid, offense_team_id, score_diff_offense + coalesce(points_scored, 0) FROM scrim) GROUP BY game_id),
results AS (SELECT g.*, c IS NOT NULL AS has_plays, CAST(c.lead * if(c.side = home_team_id, 1, -1) AS INTEGER) AS home_margin FROM games g LEFT JOIN closing USING (game_id)),
sides AS (SELECT season, season_type, home_team_id AS team_id, home_margin AS margin FROM results UNION ALL SELECT season, season_type, away_team_id, -home_margin FROM results)"""


def results(t: Tables) -> DataFrame:
    """Every game with the home side's margin after its last play (null if that is not stated) and whether it has plays."""
    kicks = t.kicks.select("game_id", "seq", "play_uid", F.col("kicking_team_id").alias("side"), (F.col("score_diff_kicking") + F.expr(_KICK_POINTS)).alias("lead"))
    snaps = t.scrimmage.select("game_id", "seq", "play_uid", F.col("offense_team_id").alias("side"), (F.col("score_diff_offense") + F.coalesce("points_scored", F.lit(0))).alias("lead"))
    closing = kicks.unionByName(snaps).groupBy("game_id").agg(F.max_by(F.struct("side", "lead"), F.struct("seq", "play_uid")).alias("c"))
    sign = F.when(F.col("c.side") == F.col("home_team_id"), 1).otherwise(-1)
    return t.games.join(closing, "game_id", "left").withColumns({"has_plays": F.col("c").isNotNull(), "home_margin": F.col("c.lead") * sign}).drop("c")


def sides(games: DataFrame) -> DataFrame:
    """Two rows a game, one from each side."""
    both = F.array(F.struct(F.col("home_team_id").alias("team_id"), F.col("home_margin").alias("margin")), F.struct(F.col("away_team_id").alias("team_id"), (-F.col("home_margin")).alias("margin")))
    return games.select("season", "season_type", F.inline(both))


def resolved_sides(t: Tables) -> DataFrame:
    """A margin of 0 is unresolved, not a tie."""
    return sides(results(t)).where("margin <> 0")


@query("r01_game_margins", RESULTS + "SELECT game_id, home_margin FROM results WHERE has_plays")
def margins(t: Tables) -> DataFrame:
    return results(t).where("has_plays").select("game_id", "home_margin")


@query("r01b_team_records", RESULTS + """
SELECT season, team_id, count(*) AS scheduled, count(*) FILTER (WHERE margin <> 0) AS played, count(*) FILTER (WHERE margin > 0) AS wins, count(*) FILTER (WHERE margin < 0) AS losses,
  100.0 * avg(CAST(margin > 0 AS INTEGER)) FILTER (WHERE margin <> 0) AS win_pct, avg(margin) FILTER (WHERE margin <> 0) AS avg_margin,
  count(*) FILTER (WHERE margin <> 0 AND abs(margin) <= 8) AS close_games, count(*) FILTER (WHERE margin <> 0 AND season_type = 'postseason') AS postseason_games
FROM sides GROUP BY season, team_id HAVING count(*) FILTER (WHERE margin <> 0) > 0""")
def team_records(t: Tables) -> DataFrame:
    """Wins and losses beside scheduled and resolved games, so that a thin record shows; one pass over both sides of the schedule."""
    d = F.col("margin")
    known = d != 0
    return sides(results(t)).groupBy("season", "team_id").agg(
        m.n().alias("scheduled"), m.n(known).alias("played"), m.n(d > 0).alias("wins"), m.n(d < 0).alias("losses"), (100.0 * F.avg(F.when(known, (d > 0).cast("int")))).alias("win_pct"),
        F.avg(F.when(known, d)).alias("avg_margin"), m.n(known & (F.abs(d) <= 8)).alias("close_games"), m.n(known & (F.col("season_type") == "postseason")).alias("postseason_games"),
    ).where("played > 0")


@query("r02_margin_mode", RESULTS + "SELECT abs(home_margin) AS margin, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM results WHERE home_margin IS NOT NULL GROUP BY 1")
def margin_mode(t: Tables) -> DataFrame:
    counts = results(t).where("home_margin IS NOT NULL").groupBy(F.abs("home_margin").alias("margin")).agg(m.n().alias("n"))
    return counts.crossJoin(counts.agg(F.sum("n").alias("el_all"))).select("margin", "n", (100.0 * F.col("n") / F.col("el_all")).alias("pct"))  # one row


#: Kicks of each job that a team's season needs to be told a model.
LEAST_KICKS = 3
JOBS = f"""
, kicked AS (SELECT season, kicking_team_id AS team_id, kicker_athlete_id AS who, count(*) FILTER (WHERE play_kind = 'kickoff') AS off, count(*) FILTER (WHERE play_kind IN ('field_goal', 'pat')) AS placed, count(*) FILTER (WHERE play_kind = 'punt') AS punted
  FROM kicks WHERE kicker_athlete_id IS NOT NULL GROUP BY ALL HAVING off + placed + punted > 0),
ranked AS (SELECT *, row_number() OVER (w ORDER BY placed DESC, off DESC, who DESC) AS at_placing, row_number() OVER (w ORDER BY off DESC, placed DESC, who DESC) AS at_kickoffs, row_number() OVER (w ORDER BY punted DESC, off DESC, who DESC) AS at_punting
  FROM kicked WINDOW w AS (PARTITION BY season, team_id)),
jobs AS (SELECT *, CAST(placer_kickoffs AS DOUBLE) / kickoffs AS placer_share, CAST(kickoff_man_kickoffs AS DOUBLE) / kickoffs AS kickoff_man_share, CAST(punter_kickoffs AS DOUBLE) / kickoffs AS punter_share,
    CAST(kickoff_man_placements AS DOUBLE) / placements AS kickoff_man_placing_share, CAST(kickoff_man_punts AS DOUBLE) / punts AS kickoff_man_punting_share,
    CASE WHEN placer = kickoff_man THEN 'placekicker also kicks off' WHEN punter = kickoff_man THEN 'punter kicks off' ELSE 'kickoff specialist' END AS model FROM (
  SELECT season, team_id, max(who) FILTER (WHERE at_placing = 1) AS placer, max(who) FILTER (WHERE at_kickoffs = 1) AS kickoff_man, max(who) FILTER (WHERE at_punting = 1) AS punter, max(off) FILTER (WHERE at_placing = 1) AS placer_kickoffs,
    max(off) FILTER (WHERE at_kickoffs = 1) AS kickoff_man_kickoffs, max(placed) FILTER (WHERE at_kickoffs = 1) AS kickoff_man_placements, max(punted) FILTER (WHERE at_kickoffs = 1) AS kickoff_man_punts, max(off) FILTER (WHERE at_punting = 1) AS punter_kickoffs,
    count(*) FILTER (WHERE off > 0) AS kickoff_men, CAST(sum(off) AS BIGINT) AS kickoffs, CAST(sum(placed) AS BIGINT) AS placements, CAST(sum(punted) AS BIGINT) AS punts FROM ranked GROUP BY season, team_id)
  WHERE least(kickoffs, placements, punts) >= {LEAST_KICKS})"""


def kicking_jobs(t: Tables, least: int = LEAST_KICKS) -> DataFrame:
    """Who places, kicks off and punts for each team and season, and how the jobs fall together.

    Of equally busy ones the busier at the other job leads, then the greater id: aggregates, no ranking of rows.
    """
    kind = F.col("play_kind")
    kicked = t.kicks.where("kicker_athlete_id IS NOT NULL").groupBy("season", F.col("kicking_team_id").alias("team_id"), F.col("kicker_athlete_id").alias("who")).agg(
        m.n(kind == "kickoff").alias("off"), m.n(kind.isin("field_goal", "pat")).alias("placed"), m.n(kind == "punt").alias("punted"),
    )
    lead = lambda *order: F.max(F.struct(*[F.col(c).alias(f"by_{c}") for c in order], "who", "off", "placed", "punted"))
    team = kicked.where("off + placed + punted > 0").groupBy("season", "team_id").agg(
        lead("placed", "off").alias("p"), lead("off", "placed").alias("k"), lead("punted", "off").alias("u"), m.n(F.col("off") > 0).alias("kickoff_men"),
        F.sum("off").alias("kickoffs"), F.sum("placed").alias("placements"), F.sum("punted").alias("punts"),
    ).where(F.least("kickoffs", "placements", "punts") >= least)
    placer, kickoff_man, punter = F.col("p.who"), F.col("k.who"), F.col("u.who")
    model = F.when(placer == kickoff_man, "placekicker also kicks off").when(punter == kickoff_man, "punter kicks off").otherwise("kickoff specialist")
    own = {"placer_kickoffs": "p.off", "kickoff_man_kickoffs": "k.off", "kickoff_man_placements": "k.placed", "kickoff_man_punts": "k.punted", "punter_kickoffs": "u.off"}
    shares = {"placer_share": ("p.off", "kickoffs"), "kickoff_man_share": ("k.off", "kickoffs"), "punter_share": ("u.off", "kickoffs"), "kickoff_man_placing_share": ("k.placed", "placements"), "kickoff_man_punting_share": ("k.punted", "punts")}
    return team.select(
        "season", "team_id", placer.alias("placer"), kickoff_man.alias("kickoff_man"), punter.alias("punter"), *[F.col(c).alias(name) for name, c in own.items()],
        "kickoff_men", "kickoffs", "placements", "punts", *[m.ratio(*pair).alias(name) for name, pair in shares.items()], model.alias("model"),
    )


@query("r03_kicker_roles", JOBS + "SELECT * FROM jobs")
def roles(t: Tables) -> DataFrame:
    return kicking_jobs(t)


@query("r05_role_mix", JOBS + "SELECT season, model, count(*) AS teams, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY season) AS share FROM jobs GROUP BY season, model")
def role_mix(t: Tables) -> DataFrame:
    return kicking_jobs(t).groupBy("season", "model").agg(m.n().alias("teams")).withColumn("share", m.share_of("teams", "season"))


@query("r06_role_switches", JOBS + "SELECT * FROM (SELECT team_id, season, model, lag(model) OVER w AS before, lag(season) OVER w AS season_before FROM jobs WINDOW w AS (PARTITION BY team_id ORDER BY season)) WHERE season = season_before + 1 AND model <> before")
def role_switches(t: Tables) -> DataFrame:
    """Teams whose model changed from one season to the next; gaps are no switches."""
    w = Window.partitionBy("team_id").orderBy("season")
    r = kicking_jobs(t).select("team_id", "season", "model", F.lag("model").over(w).alias("before"), F.lag("season").over(w).alias("season_before"))
    return r.where((F.col("season") == F.col("season_before") + 1) & (F.col("model") != F.col("before")))


def two_sample(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Difference of two groups' means with Welch's standard error and t, in one pass."""
    stats = [f(F.when(F.col(group) == v, F.col(value))).alias(f"{n}_{s}") for s, v in (("a", a), ("b", b)) for n, f in (("mean", F.avg), ("var", F.var_samp), ("n", F.count))]
    se = F.sqrt(F.col("var_a") / F.nullif("n_a", F.lit(0)) + F.col("var_b") / F.nullif("n_b", F.lit(0)))
    d = F.col("mean_a") - F.col("mean_b")
    return df.agg(*stats).select("n_a", "n_b", d.alias("difference"), se.alias("se"), (d / F.nullif(se, F.lit(0.0))).alias("t"), (d - 1.96 * se).alias("low"), (d + 1.96 * se).alias("high"))


@query("r07_two_sample")
def surface_difference(t: Tables) -> DataFrame:
    """Punts on grass against turf.  (No oracle: sums of squares differ in the last digits; a test holds it to tolerance.)"""
    return two_sample(t.play_wide.where("play_kind = 'punt'"), "surface", "punt_gross_yds", "grass", "turf")


@query("r08_paired_difference", """, x AS (SELECT kicking_team_id AS team_id, avg(punt_gross_yds) FILTER (WHERE surface = 'grass') AS grass, avg(punt_gross_yds) FILTER (WHERE surface = 'turf') AS turf FROM play_wide WHERE play_kind = 'punt' GROUP BY 1)
SELECT team_id, grass - turf AS difference FROM x WHERE grass IS NOT NULL AND turf IS NOT NULL""")
def paired_difference(t: Tables) -> DataFrame:
    wide = t.play_wide.where("play_kind = 'punt'").groupBy(F.col("kicking_team_id").alias("team_id")).pivot("surface", ["grass", "turf"]).agg(F.avg("punt_gross_yds"))
    return wide.where("grass IS NOT NULL AND turf IS NOT NULL").select("team_id", (F.col("grass") - F.col("turf")).alias("difference"))


#: Career jobs: the volume a season needs and what counts as volume.
FLOOR = 3
_PANEL = f"""
, raw AS (SELECT player_id AS aid, season, count(*) FILTER (WHERE play_kind = 'field_goal' AND outcome <> 'Negated') AS fga, count(*) FILTER (WHERE outcome = 'Made') AS fgm FROM st WHERE player_id IS NOT NULL GROUP BY ALL),
panel AS (SELECT *, row_number() OVER (PARTITION BY aid ORDER BY season) AS exp, (SELECT min(season) FROM raw r WHERE r.aid = q.aid) = (SELECT min(season) FROM raw) AS censored,
  CASE WHEN season < (SELECT max(season) FROM raw) THEN max(season) OVER (PARTITION BY aid) > season END AS came_back FROM raw q WHERE fga >= {FLOOR})"""


def career_panel(t: Tables, floor: int = FLOOR) -> DataFrame:
    """Player-seasons of enough volume, numbered by order; the floor comes before the numbering.

    censored: the career began before the corpus, judged on all seasons.  came_back is unknown in the last one.
    """
    raw = t.st.where("player_id IS NOT NULL").groupBy(F.col("player_id").alias("aid"), "season").agg(m.n((F.col("play_kind") == "field_goal") & (F.col("outcome") != "Negated")).alias("fga"), m.n(F.col("outcome") == "Made").alias("fgm"))
    bounds = raw.agg(F.min("season").alias("el_first"), F.max("season").alias("el_last"))
    whole = Window.partitionBy("aid")
    seen = raw.withColumn("el_begun", F.min("season").over(whole)).where(F.col("fga") >= floor).crossJoin(bounds)  # one row
    return seen.select(
        "aid", "season", "fga", "fgm", F.row_number().over(whole.orderBy("season")).cast("bigint").alias("exp"), (F.col("el_begun") == F.col("el_first")).alias("censored"),
        F.when(F.col("season") < F.col("el_last"), F.max("season").over(whole) > F.col("season")).alias("came_back"),
    )


@query("r11_career_panel", _PANEL + "SELECT * FROM panel")
def panel(t: Tables) -> DataFrame:
    return career_panel(t)


@query("r12_cohort_curve", _PANEL + ", g AS (SELECT exp, count(*) AS players, CAST(sum(fgm) AS DOUBLE) / nullif(sum(fga), 0) AS rate FROM panel GROUP BY 1) SELECT * FROM g WHERE exp < coalesce((SELECT min(exp) FROM g WHERE players < 15), 1000)")
def cohort_curve(t: Tables, thin: int = 15) -> DataFrame:
    """Pooled rate per year of experience, up to the first year with too few players."""
    g = career_panel(t).groupBy("exp").agg(m.n().alias("players"), (F.sum("fgm") / F.nullif(F.sum("fga"), F.lit(0))).alias("rate"))
    stop = g.agg(F.coalesce(F.min(F.when(F.col("players") < thin, F.col("exp"))), F.lit(1000)).alias("el_stop"))
    return g.crossJoin(stop).where("exp < el_stop").drop("el_stop")  # one row


@query("r14_paired_steps", _PANEL + """SELECT a.exp, count(*) AS players, count(*) FILTER (WHERE CAST(b.fgm AS DOUBLE) / b.fga > CAST(a.fgm AS DOUBLE) / a.fga) AS better, count(*) FILTER (WHERE CAST(b.fgm AS DOUBLE) / b.fga < CAST(a.fgm AS DOUBLE) / a.fga) AS worse FROM panel a JOIN panel b ON b.aid = a.aid AND b.exp = a.exp + 1 GROUP BY 1""")
def paired_steps(t: Tables) -> DataFrame:
    """The same players in two years that follow: the next row of one window, no self-join."""
    w = Window.partitionBy("aid").orderBy("exp")
    rate = F.col("fgm") / F.col("fga")
    p = career_panel(t).withColumn("rate", rate).withColumn("next", F.lead("rate").over(w)).where("next IS NOT NULL")
    return p.groupBy("exp").agg(m.n().alias("players"), m.n(F.col("next") > F.col("rate")).alias("better"), m.n(F.col("next") < F.col("rate")).alias("worse"))


@query("r15_survivorship", _PANEL + "SELECT exp, came_back, count(*) AS players, CAST(sum(fgm) AS DOUBLE) / nullif(sum(fga), 0) AS rate FROM panel WHERE came_back IS NOT NULL GROUP BY ALL")
def survivorship(t: Tables) -> DataFrame:
    return career_panel(t).where("came_back IS NOT NULL").groupBy("exp", "came_back").agg(m.n().alias("players"), (F.sum("fgm") / F.nullif(F.sum("fga"), F.lit(0))).alias("rate"))


@query("r16_by_player_bands", _PANEL + "SELECT aid, CAST(sum(fgm) FILTER (WHERE exp = 1) AS BIGINT) AS made_1, CAST(sum(fgm) FILTER (WHERE exp BETWEEN 2 AND 3) AS BIGINT) AS made_2_3, CAST(sum(fgm) FILTER (WHERE exp >= 4) AS BIGINT) AS made_4 FROM panel GROUP BY 1")
def by_player_bands(t: Tables) -> DataFrame:
    e = F.col("exp")
    return career_panel(t).groupBy("aid").agg(m.total("fgm", e == 1).alias("made_1"), m.total("fgm", e.between(2, 3)).alias("made_2_3"), m.total("fgm", e >= 4).alias("made_4"))
