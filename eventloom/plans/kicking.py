"""Panels on who does which kicking job, and how well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import metrics as m
from eventloom.plans.binding import Tables
from eventloom.plans.intake import FEW, MANY
from eventloom.plans.panels import next_snap
from eventloom.plans.registry import query
from eventloom.plans.reports import JOBS, LEAST_KICKS, kicking_jobs

SHARED, APART, PUNTER = "placekicker also kicks off", "kickoff specialist", "punter kicks off"
MODELS = {"placekicker": SHARED, "specialist": APART, "punter": PUNTER}


def _mean(value: str | Column, test: Column | None = None) -> Column:
    """A mean of doubles to four places: their sum depends on its order in the last ones."""
    return F.round(m.mean(value, test), 4)


_MODEL_PCT = ", ".join(f"100.0 * avg(CAST(model = '{v}' AS INTEGER)) AS pct_{k}" for k, v in MODELS.items())


def _model_percents() -> list[Column]:
    return [m.percent(F.col("model") == v).alias(f"pct_{k}") for k, v in MODELS.items()]


@query("r05c_eligibility", JOBS + """, every AS (SELECT season, team_id, sum(off) AS kickoffs, sum(placed) AS placements, sum(punted) AS punts FROM kicked GROUP BY ALL)
SELECT season, count(*) AS team_seasons, count(model) AS met_floor, avg(kickoff_men) AS men_kicking_off FROM every LEFT JOIN (SELECT season, team_id, model, kickoff_men FROM jobs) USING (season, team_id) GROUP BY season""")
def eligibility(t: Tables) -> DataFrame:
    """Team-seasons before and after the floor of volume; the men who kick off are counted after it."""
    met = F.least("kickoffs", "placements", "punts") >= LEAST_KICKS
    return kicking_jobs(t, 0).groupBy("season").agg(m.n().alias("team_seasons"), m.n(met).alias("met_floor"), m.mean("kickoff_men", met).alias("men_kicking_off"))


@query("r05d_headline", JOBS + f"""SELECT count(*) AS team_seasons, {_MODEL_PCT}, round(100.0 * avg(placer_share), 4) AS placer_of_kickoffs,
  round(100.0 * avg(kickoff_man_placing_share), 4) AS kickoff_man_of_placements, round(100.0 * avg(punter_share), 4) AS punter_of_kickoffs FROM jobs""")
def headline(t: Tables) -> DataFrame:
    """How often each model occurs, and mean shares of the work."""
    share = {"placer_of_kickoffs": "placer_share", "kickoff_man_of_placements": "kickoff_man_placing_share", "punter_of_kickoffs": "punter_share"}
    return kicking_jobs(t).agg(m.n().alias("team_seasons"), *_model_percents(), *[_mean(100.0 * F.col(c)).alias(k) for k, c in share.items()])


@query("r05e_share_bands", JOBS + """, b AS (SELECT CASE WHEN placer_kickoffs = 0 THEN -1 ELSE 10 * placer_kickoffs // kickoffs END AS tenth FROM jobs)
SELECT CASE tenth WHEN -1 THEN '0%' WHEN 10 THEN '100%' ELSE 10 * tenth || '-' || (10 * tenth + 10) || '%' END AS band, count(*) AS team_seasons, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM b GROUP BY tenth""")
def share_bands(t: Tables) -> DataFrame:
    """Team-seasons by the placekicker's share of the kickoffs, none and all apart; tenths by whole numbers, so that 0.3 is in its own."""
    tenth = F.when(F.col("placer_kickoffs") == 0, -1).otherwise(F.expr("10 * placer_kickoffs div kickoffs"))
    n = kicking_jobs(t).groupBy(tenth.alias("tenth")).agg(m.n().alias("team_seasons"))
    low = (10 * F.col("tenth")).cast("string")
    band = F.when(F.col("tenth") == -1, "0%").when(F.col("tenth") == 10, "100%").otherwise(F.concat(low, F.lit("-"), (10 * F.col("tenth") + 10).cast("string"), F.lit("%")))
    all_rows = n.agg(F.sum("team_seasons").alias("el_all"))
    return n.crossJoin(all_rows).select(band.alias("band"), "team_seasons", (100.0 * F.col("team_seasons") / F.col("el_all")).alias("pct"))  # one row


@query("r05f_by_season", JOBS + f"""SELECT season, count(*) AS team_seasons, {_MODEL_PCT}, round(100.0 * avg(placer_share), 4) AS placer_of_kickoffs,
  100.0 * avg(CAST(10 * placer_kickoffs >= 9 * kickoffs AS INTEGER)) AS pct_nearly_all, 100.0 * avg(CAST(10 * placer_kickoffs <= kickoffs AS INTEGER)) AS pct_hardly_any FROM jobs GROUP BY season""")
def by_season(t: Tables) -> DataFrame:
    """Whether the jobs grow apart over the seasons."""
    mine, everyone = 10 * F.col("placer_kickoffs"), F.col("kickoffs")
    return kicking_jobs(t).groupBy("season").agg(
        m.n().alias("team_seasons"), *_model_percents(), _mean(100.0 * F.col("placer_share")).alias("placer_of_kickoffs"),
        m.percent(mine >= 9 * everyone).alias("pct_nearly_all"), m.percent(mine <= everyone).alias("pct_hardly_any"),
    )


@query("r05g_punters", JOBS + """SELECT count(*) AS team_seasons, 100.0 * avg(CAST(punter_kickoffs = 0 AS INTEGER)) AS pct_never, 100.0 * avg(CAST(punter_kickoffs BETWEEN 1 AND 4 AS INTEGER)) AS pct_now_and_then,
  100.0 * avg(CAST(punter_kickoffs >= 5 AND 2 * punter_kickoffs < kickoffs AS INTEGER)) AS pct_minority, 100.0 * avg(CAST(2 * punter_kickoffs >= kickoffs AS INTEGER)) AS pct_majority, 100.0 * avg(CAST(placer = punter AS INTEGER)) AS pct_places_too FROM jobs""")
def punters(t: Tables) -> DataFrame:
    """How much of the kicking off the first punter takes."""
    own = F.col("punter_kickoffs")
    return kicking_jobs(t).agg(
        m.n().alias("team_seasons"), m.percent(own == 0).alias("pct_never"), m.percent(own.between(1, 4)).alias("pct_now_and_then"), m.percent((own >= 5) & (2 * own < F.col("kickoffs"))).alias("pct_minority"),
        m.percent(2 * own >= F.col("kickoffs")).alias("pct_majority"), m.percent(F.col("placer") == F.col("punter")).alias("pct_places_too"),
    )


@query("r05h_third_man", JOBS + f"""SELECT count(*) AS team_seasons, avg(kickoff_man_kickoffs) AS kickoffs_each, avg(kickoff_man_placements) AS placements_each, avg(kickoff_man_punts) AS punts_each,
  100.0 * avg(CAST(kickoff_man_placements + kickoff_man_punts = 0 AS INTEGER)) AS pct_nothing_else FROM jobs WHERE model = '{APART}'""")
def third_man(t: Tables) -> DataFrame:
    """What else a man does who kicks off and neither places nor punts first."""
    own = {"kickoffs_each": "kickoff_man_kickoffs", "placements_each": "kickoff_man_placements", "punts_each": "kickoff_man_punts"}
    idle = F.col("kickoff_man_placements") + F.col("kickoff_man_punts") == 0
    return kicking_jobs(t).where(F.col("model") == APART).agg(m.n().alias("team_seasons"), *[F.avg(c).alias(k) for k, c in own.items()], m.percent(idle).alias("pct_nothing_else"))


def with_jobs(kicks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Kicks by a known kicker, each with his team's jobs of that season; teams below the floor drop out."""
    return kicks.where("kicker_athlete_id IS NOT NULL").join(jobs.withColumnRenamed("team_id", "kicking_team_id"), ["season", "kicking_team_id"])


@query("r05i_kickoff_quality", JOBS + """SELECT CASE kicker_athlete_id WHEN placer THEN 'placekicker' WHEN punter THEN 'punter' WHEN kickoff_man THEN 'kickoff specialist' ELSE 'someone else' END AS who, count(*) AS n,
  100.0 * avg(CAST(onside AS INTEGER)) AS pct_onside, 100.0 * avg(CAST(touchback AS INTEGER)) FILTER (WHERE NOT onside AND returned IS NOT NULL) AS touchback_pct, avg(kickoff_yds) FILTER (WHERE NOT onside) AS yards
FROM kicks JOIN jobs ON jobs.season = kicks.season AND team_id = kicking_team_id WHERE play_kind = 'kickoff' AND kicker_athlete_id IS NOT NULL GROUP BY 1""")
def kickoff_quality(t: Tables) -> DataFrame:
    """Kickoffs by who took them; onside ones count only in their own share."""
    man, deep = F.col("kicker_athlete_id"), ~F.col("onside")
    who = F.when(man == F.col("placer"), "placekicker").when(man == F.col("punter"), "punter").when(man == F.col("kickoff_man"), "kickoff specialist").otherwise("someone else")
    jobs = kicking_jobs(t).select("season", "team_id", "placer", "punter", "kickoff_man")
    return with_jobs(t.kicks.where("play_kind = 'kickoff'"), jobs).groupBy(who.alias("who")).agg(
        m.n().alias("n"), m.percent("onside").alias("pct_onside"), m.percent("touchback", deep & F.col("returned").isNotNull()).alias("touchback_pct"), m.mean("kickoff_yds", deep).alias("yards"),
    )


@query("r05j_placing_quality", JOBS + """SELECT model, count(*) AS attempts, 100.0 * avg(CAST(fg_made AS INTEGER)) AS made_pct, avg(fg_distance_yds) AS distance, count(*) FILTER (WHERE fg_distance_yds >= 50) AS long_attempts,
  100.0 * avg(CAST(fg_made AS INTEGER)) FILTER (WHERE fg_distance_yds >= 50) AS long_pct
FROM kicks JOIN jobs ON jobs.season = kicks.season AND team_id = kicking_team_id AND kicker_athlete_id = placer WHERE play_kind = 'field_goal' AND fg_made IS NOT NULL GROUP BY model""")
def placing_quality(t: Tables) -> DataFrame:
    """Field goals of first placekickers, by their team's model."""
    far = F.col("fg_distance_yds") >= 50
    tries = with_jobs(t.kicks.where("play_kind = 'field_goal' AND fg_made IS NOT NULL"), kicking_jobs(t).select("season", "team_id", "placer", "model")).where("kicker_athlete_id = placer")
    return tries.groupBy("model").agg(m.n().alias("attempts"), m.percent("fg_made").alias("made_pct"), F.avg("fg_distance_yds").alias("distance"), m.n(far).alias("long_attempts"), m.percent("fg_made", far).alias("long_pct"))


_SEASONS = JOBS + f"""
, man AS (SELECT season, kicking_team_id AS team_id, kicker_athlete_id AS who, count(*) FILTER (WHERE play_kind = 'kickoff') AS ko, count(*) FILTER (WHERE play_kind = 'field_goal') AS fg, count(*) FILTER (WHERE play_kind = 'pat') AS pat, count(*) FILTER (WHERE play_kind = 'punt') AS pu
  FROM kicks WHERE kicker_athlete_id IS NOT NULL GROUP BY ALL),
typed AS (SELECT man.*, position, known_name, CASE WHEN ko >= {MANY} AND fg + pat < {FEW} AND pu < {FEW} THEN 'kickoff specialist' WHEN fg + pat >= {MANY} AND ko >= {MANY} THEN 'placekicker who kicks off' WHEN fg + pat >= {MANY} AND ko < {FEW} THEN 'placekicker only'
    WHEN pu >= {MANY} AND ko >= {MANY} THEN 'punter who kicks off' WHEN pu >= {MANY} AND ko < {FEW} THEN 'punter only' ELSE 'mixed / low volume' END AS archetype
  FROM man SEMI JOIN jobs USING (season, team_id) LEFT JOIN athletes ON athlete_id = who)"""


def player_seasons(t: Tables) -> DataFrame:
    """What each man kicked for a team in a season, with the archetype this makes him; teams below the floor drop out."""
    kind = F.col("play_kind")
    man = t.kicks.where("kicker_athlete_id IS NOT NULL").groupBy("season", F.col("kicking_team_id").alias("team_id"), F.col("kicker_athlete_id").alias("who")).agg(
        m.n(kind == "kickoff").alias("ko"), m.n(kind == "field_goal").alias("fg"), m.n(kind == "pat").alias("pat"), m.n(kind == "punt").alias("pu"),
    )
    volume = {"ko": F.col("ko"), "pk": F.col("fg") + F.col("pat"), "pu": F.col("pu")}
    does, hardly = (lambda c: volume[c] >= MANY), (lambda c: volume[c] < FEW)
    archetype = (
        F.when(does("ko") & hardly("pk") & hardly("pu"), "kickoff specialist").when(does("pk") & does("ko"), "placekicker who kicks off").when(does("pk") & hardly("ko"), "placekicker only")
        .when(does("pu") & does("ko"), "punter who kicks off").when(does("pu") & hardly("ko"), "punter only").otherwise("mixed / low volume")
    )
    kept = man.join(kicking_jobs(t).select("season", "team_id"), ["season", "team_id"], "left_semi")
    named = t.athletes.select(F.col("athlete_id").alias("who"), "position", "known_name")
    return kept.join(named, "who", "left").withColumn("archetype", archetype)


@query("r05k_archetypes", _SEASONS + """, p AS (SELECT archetype, position, count(*) AS n FROM typed GROUP BY ALL), u AS (SELECT archetype, arg_max(position, (n, position)) FILTER (WHERE position IS NOT NULL) AS usual_position FROM p GROUP BY 1)
SELECT archetype, count(*) AS player_seasons, count(DISTINCT who) AS people, avg(ko) AS kickoffs, avg(fg) AS field_goals, avg(pat) AS pats, avg(pu) AS punts, any_value(usual_position) AS usual_position FROM typed JOIN u USING (archetype) GROUP BY archetype""")
def archetypes(t: Tables) -> DataFrame:
    """Player-seasons by archetype and the position most of them are listed at; counted by position first, so the mode needs no second pass over the seasons."""
    own = ("ko", "fg", "pat", "pu")
    men = player_seasons(t).groupBy("archetype", "position", "who").agg(m.n().alias("n"), *[F.sum(c).alias(c) for c in own])
    places = men.groupBy("archetype", "position").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in own], m.n().alias("men"))
    out = places.groupBy("archetype").agg(
        F.sum("n").alias("player_seasons"), F.sum("men").alias("people"), *[(F.sum(c) / F.sum("n")).alias(name) for c, name in zip(own, ("kickoffs", "field_goals", "pats", "punts"), strict=True)],
        m.arg_max("position", ["n", "position"], F.lit(True)).alias("usual_position"),
    )
    return out


@query("r05l_promotions", _SEASONS + f""", s AS (SELECT who, min(season) FILTER (WHERE archetype = 'kickoff specialist') AS began, max(season) FILTER (WHERE fg + pat >= {MANY}) AS placed FROM typed GROUP BY 1)
SELECT count(began) AS specialists, count(*) FILTER (WHERE placed > began) AS placed_later, 100.0 * count(*) FILTER (WHERE placed > began) / nullif(count(began), 0) AS pct FROM s""")
def promotions(t: Tables) -> DataFrame:
    """Kickoff specialists who placed in a later season: first season of the one job against the last of the other, no self-join."""
    first = F.min(F.when(F.col("archetype") == "kickoff specialist", F.col("season")))
    last = F.max(F.when(F.col("fg") + F.col("pat") >= MANY, F.col("season")))
    careers = player_seasons(t).groupBy("who").agg(first.alias("began"), last.alias("placed"))
    later = m.n(F.col("placed") > F.col("began"))
    return careers.agg(F.count("began").alias("specialists"), later.alias("placed_later"), (100.0 * later / F.nullif(F.count("began"), F.lit(0))).alias("pct"))


@query("r05m_stability", JOBS + """, g AS (SELECT season, kicking_team_id AS team_id, game_id, kicker_athlete_id AS who, count(*) AS n FROM kicks WHERE play_kind = 'kickoff' AND kicker_athlete_id IS NOT NULL GROUP BY ALL),
l AS (SELECT season, team_id, game_id, arg_max(who, (n, who)) AS lead FROM g GROUP BY ALL)
SELECT season, count(*) AS team_games, 100.0 * avg(CAST(lead = kickoff_man AS INTEGER)) AS pct_led_by_season_leader FROM l JOIN jobs USING (season, team_id) GROUP BY season""")
def stability(t: Tables) -> DataFrame:
    """How many of a team's games are led by the man who leads its season; games of one kickoff count here too."""
    kicks = t.kicks.where("play_kind = 'kickoff' AND kicker_athlete_id IS NOT NULL")
    men = kicks.groupBy("season", F.col("kicking_team_id").alias("team_id"), "game_id", F.col("kicker_athlete_id").alias("who")).agg(m.n().alias("n"))
    games = men.groupBy("season", "team_id", "game_id").agg(m.modal("who", "n").alias("lead"))
    both = games.join(kicking_jobs(t).select("season", "team_id", "kickoff_man"), ["season", "team_id"])
    return both.groupBy("season").agg(m.n().alias("team_games"), m.percent(F.col("lead") == F.col("kickoff_man")).alias("pct_led_by_season_leader"))


@query("r05n_kickoff_men", JOBS + """
, s AS (SELECT game_id, seq, play_uid, receiving_team_id AS team_id, 1 AS q, NULL::INTEGER AS y FROM kicks WHERE play_kind = 'kickoff' UNION ALL SELECT game_id, seq, play_uid, offense_team_id, 0, yards_to_goal FROM scrim),
w AS (SELECT *, first_value(CASE WHEN q = 0 THEN y END IGNORE NULLS) OVER (PARTITION BY game_id, team_id ORDER BY seq, play_uid ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM s),
o AS (SELECT k.season, kicking_team_id AS team_id, kicker_athlete_id AS who, kickoff_man, returned, return_yds, returned_for_td, CASE WHEN returned IS NOT NULL THEN CAST(touchback AS INTEGER) END AS tb, 100 - nxt AS start
  FROM kicks k JOIN w ON w.play_uid = k.play_uid AND q = 1 JOIN jobs ON jobs.season = k.season AND jobs.team_id = kicking_team_id WHERE k.play_kind = 'kickoff' AND NOT onside AND kicker_athlete_id IS NOT NULL),
e AS (SELECT season, avg(tb) AS tb_era, avg(start) AS start_era FROM o GROUP BY 1)
SELECT who, known_name, string_agg(DISTINCT display_name, ', ' ORDER BY display_name) AS teams, count(DISTINCT season) AS seasons, min(season) || '-' || max(season) AS span, count(*) AS kickoffs, 100.0 * avg(tb) AS tb_pct, round(100.0 * (avg(tb) - avg(tb_era) FILTER (WHERE tb IS NOT NULL)), 4) AS tb_over_era,
  100.0 * avg(CAST(returned AS INTEGER)) AS return_pct, avg(return_yds) FILTER (WHERE returned) AS return_yards, avg(start) AS start, round(avg(start) - avg(start_era), 4) AS start_over_era, count(*) FILTER (WHERE returned_for_td) AS touchdowns
FROM o JOIN e USING (season) JOIN teams USING (team_id) LEFT JOIN athletes ON athlete_id = who WHERE who = kickoff_man GROUP BY who, known_name HAVING count(*) >= 5 ORDER BY kickoffs DESC, who LIMIT 20""")
def kickoff_men(t: Tables, least: int = 5, top: int = 20) -> DataFrame:
    """The longest-serving men who led their team at kicking off, against the eras they kicked in.

    Kickoffs are added up by man, team and season before an era or a name is joined to them.  The touchback rate
    is held against the seasons of kickoffs with a known return, the start against those of all of them.  A top-k report.
    """
    jobs = kicking_jobs(t).select("season", "team_id", "kickoff_man")
    kickoffs = next_snap(t, "season", "kicking_team_id", "kicker_athlete_id", "returned", "touchback", "onside", "return_yds", "returned_for_td")
    deep = with_jobs(kickoffs.where("NOT onside"), jobs)
    tb, start = F.when(F.col("returned").isNotNull(), F.col("touchback").cast("int")), 100 - F.col("start_yards")
    own = deep.groupBy("season", "kicking_team_id", F.col("kicker_athlete_id").alias("who"), (F.col("kicker_athlete_id") == F.col("kickoff_man")).alias("leads")).agg(
        m.n().alias("n"), F.count(tb).alias("tb_n"), F.sum(tb).alias("tb"), F.count(start).alias("start_n"), F.sum(start).alias("start"),
        F.count("returned").alias("known"), m.n(F.col("returned")).alias("back"), m.total("return_yds", F.col("returned")).alias("back_yds"), F.count(F.when(F.col("returned"), F.col("return_yds"))).alias("back_n"), m.n(F.col("returned_for_td")).alias("td"),
    )
    era = own.groupBy("season").agg((F.sum("tb") / F.nullif(F.sum("tb_n"), F.lit(0))).alias("tb_era"), (F.sum("start") / F.nullif(F.sum("start_n"), F.lit(0))).alias("start_era"))
    teams = t.teams.select(F.col("team_id").alias("kicking_team_id"), "display_name")
    led = own.where("leads").join(era, "season").join(teams, "kicking_team_id")
    rate = lambda a, b: F.sum(a) / F.nullif(F.sum(b), F.lit(0))
    over = lambda c, weight: rate(c, f"{c}_n") - F.sum(F.col(weight) * F.col(f"{c}_era")) / F.nullif(F.sum(weight), F.lit(0))
    men = led.groupBy("who").agg(
        m.text_list("display_name", ", ").alias("teams"), F.countDistinct("season").alias("seasons"), F.concat(F.min("season").cast("string"), F.lit("-"), F.max("season").cast("string")).alias("span"), F.sum("n").alias("kickoffs"),
        (100.0 * rate("tb", "tb_n")).alias("tb_pct"), F.round(100.0 * over("tb", "tb_n"), 4).alias("tb_over_era"), (100.0 * rate("back", "known")).alias("return_pct"), rate("back_yds", "back_n").alias("return_yards"),
        rate("start", "start_n").alias("start"), F.round(over("start", "n"), 4).alias("start_over_era"), F.sum("td").alias("touchdowns"),
    ).where(F.col("kickoffs") >= least)
    return men.orderBy(F.desc("kickoffs"), "who").limit(top).join(t.athletes.select(F.col("athlete_id").alias("who"), "known_name"), "who", "left")


@query("r05o_heaviest_duty", _SEASONS + """SELECT who, any_value(known_name) AS known_name, count(*) AS seasons, CAST(sum(ko) AS BIGINT) AS kickoffs, CAST(sum(fg) AS BIGINT) AS field_goals, CAST(sum(pat) AS BIGINT) AS pats, string_agg(DISTINCT display_name, ', ' ORDER BY display_name) AS teams
FROM typed JOIN teams USING (team_id) WHERE least(ko, fg + pat) >= 1 GROUP BY who ORDER BY sum(ko + fg + pat) DESC, who LIMIT 15""")
def heaviest_duty(t: Tables, top: int = 15) -> DataFrame:
    """Men who both place and kick off, by all they kicked.  A top-k report."""
    both = player_seasons(t).where("least(ko, fg + pat) >= 1").join(t.teams.select("team_id", "display_name"), "team_id")
    men = both.groupBy("who").agg(
        F.max("known_name").alias("known_name"), m.n().alias("seasons"), F.sum("ko").alias("kickoffs"), F.sum("fg").alias("field_goals"), F.sum("pat").alias("pats"), m.text_list("display_name", ", ").alias("teams"),
    )
    return men.orderBy((F.col("kickoffs") + F.col("field_goals") + F.col("pats")).desc(), "who").limit(top)
