"""Careers by job: seasons of enough volume numbered by order, steps of the same people, and who kept the job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators import metrics as m


@dataclass(frozen=True)
class Job:
    volume: str
    floor: int
    metrics: tuple[str, ...]


@dataclass(frozen=True)
class Metric:
    """over: the denominator, or None for a single kick's value; better: the direction of good, 0 if there is none."""

    value: str
    over: str | None
    better: int


JOBS = {"placekick": Job("fga", 5, ("fg_pct", "dist", "long")), "punt": Job("punts", 20, ("net", "gross", "ret_rate")), "kickoff": Job("kos", 20, ("tb_rate", "ko_dist"))}
METRICS = {
    "fg_pct": Metric("fgm", "fga", 1), "dist": Metric("fg_dist_sum", "fg_dist_n", 0), "long": Metric("longest", None, 1),
    "net": Metric("net_sum", "net_n", 1), "gross": Metric("gross_sum", "gross_n", 1), "ret_rate": Metric("run_back", "punts", -1),
    "tb_rate": Metric("touchbacks", "ko_denom", 1), "ko_dist": Metric("ko_dist_sum", "ko_dist_n", 1),
}


def season_sums(st: DataFrame, *player: str, in_progress: Sequence[int] = ()) -> DataFrame:
    """Tallies of the kick lens by player and season; seasons in progress and rows without a player are left out."""
    kind, out = F.col("play_kind"), F.col("outcome")
    tried, punt, kickoff = (kind == "field_goal") & (out != "Negated"), kind == "punt", kind == "kickoff"
    rows = st.dropna(subset=list(player)).where(~F.col("season").isin(list(in_progress)))
    return rows.groupBy(*player, "season").agg(
        m.n(tried).alias("fga"), m.n(tried & (out == "Made")).alias("fgm"), m.total("fg_distance_yds", tried).alias("fg_dist_sum"), m.n(tried & F.col("fg_distance_yds").isNotNull()).alias("fg_dist_n"), m.top("fg_distance_yds", out == "Made").alias("longest"),
        m.n(punt).alias("punts"), m.total("punt_net_yds", punt).alias("net_sum"), m.n(punt & F.col("punt_net_yds").isNotNull()).alias("net_n"), m.total("punt_gross_yds", punt).alias("gross_sum"), m.n(punt & F.col("punt_gross_yds").isNotNull()).alias("gross_n"), m.n(punt & (out == "Returned")).alias("run_back"),
        m.n(kickoff).alias("kos"), m.n(kickoff & ~F.coalesce("onside", F.lit(False))).alias("ko_denom"), m.n(kickoff & (out == "Touchback")).alias("touchbacks"), m.total("kickoff_yds", kickoff).alias("ko_dist_sum"), m.n(kickoff & F.col("kickoff_yds").isNotNull()).alias("ko_dist_n"),
    )


def job_seasons(sums: DataFrame, *player: str, floors: dict[str, int] | None = None, drop_censored: bool = True) -> DataFrame:
    """A row for each job, player and season of enough volume, with exp, censored and came_back.

    The floor comes before the numbering, so a season below it is no first year; years are numbered by order and a
    gap is none.  censored, judged on all jobs: the player is there in the first season of all and may have begun
    before; such players are left out unless drop_censored is false.  came_back is unknown in the last season.
    """
    least = {k: j.floor for k, j in JOBS.items()} | (floors or {})
    whole = Window.partitionBy(*player)
    bounds = sums.agg(F.min("season").alias("el_first"), F.max("season").alias("el_last"))
    begun = sums.withColumn("el_begun", F.min("season").over(whole)).crossJoin(bounds).withColumn("censored", F.col("el_begun") == F.col("el_first"))  # one row
    if drop_censored:
        begun = begun.where("NOT censored")
    jobs = F.explode(F.array(*[F.struct(F.lit(k).alias("job"), F.col(j.volume).alias("volume"), F.lit(least[k]).alias("floor")) for k, j in JOBS.items()]))
    rows = begun.withColumn("el", jobs).where("el.volume >= el.floor").withColumns({"job": F.col("el.job"), "volume": F.col("el.volume")})
    career = Window.partitionBy("job", *player)
    return rows.withColumns({
        "exp": F.row_number().over(career.orderBy("season")).cast("long"),
        "came_back": F.when(F.col("season") < F.col("el_last"), F.max("season").over(career) > F.col("season")),
    }).drop("el", "el_begun", "el_first", "el_last")


def measured(panel: DataFrame) -> DataFrame:
    """A row for each metric of each job-season: metric, num, den, better; a metric of one kick has a den of 1 where it has a value."""
    def entry(job: str, name: str) -> Column:
        x = METRICS[name]
        den = F.col(x.over) if x.over else F.when(F.col(x.value).isNotNull(), F.lit(1))
        return F.struct(F.lit(job).alias("of"), F.lit(name).alias("metric"), F.col(x.value).cast("long").alias("num"), den.cast("long").alias("den"), F.lit(x.better).alias("better"))

    entries = F.array(*[entry(job, name) for job, j in JOBS.items() for name in j.metrics])
    return panel.withColumn("el", F.explode(entries)).where("el.of = job").select("*", "el.metric", "el.num", "el.den", "el.better").drop("el")


def _value(num: str, den: str) -> Column:
    return F.col(num) / F.nullif(F.col(den), F.lit(0))


def steps(measures: DataFrame, *player: str, thin: int = 15) -> DataFrame:
    """The same people in a year and their next one: pooled before and after, and how many got better by the metric's own direction."""
    w = Window.partitionBy("job", "metric", *player).orderBy("exp")
    both = measures.withColumns({"num2": F.lead("num").over(w), "den2": F.lead("den").over(w)}).withColumn("d", (_value("num2", "den2") - _value("num", "den")) * F.when(F.col("better") < 0, -1).otherwise(1)).where("d IS NOT NULL")
    out = both.groupBy("job", "metric", "exp").agg(
        m.n().alias("players"), (F.sum("num") / F.sum("den")).alias("before"), (F.sum("num2") / F.sum("den2")).alias("after"),
        m.n(F.col("d") > 0).alias("better"), m.n(F.col("d") < 0).alias("worse"), m.n(F.col("d") == 0).alias("level"),
    )
    return out.withColumns({"change": F.col("after") - F.col("before"), "thin": F.col("players") < thin})


def kept_the_job(measures: DataFrame, least: int = 5) -> DataFrame:
    """Those who got another season against those who did not, in the same year; a curve ends before its first thin year, so it has no hole."""
    stayed, gone = F.col("came_back"), ~F.col("came_back")
    rate = lambda side: F.sum(F.when(side, F.col("num"))) / F.nullif(F.sum(F.when(side & F.col("num").isNotNull(), F.col("den"))), F.lit(0))
    years = measures.where("came_back IS NOT NULL").groupBy("job", "metric", "exp").agg(m.n(stayed).alias("stayed_n"), m.n(gone).alias("gone_n"), rate(stayed).alias("stayed"), rate(gone).alias("gone"))
    w = Window.partitionBy("job", "metric").orderBy("exp")
    enough = (F.least("stayed_n", "gone_n") >= least) & (F.col("exp") == F.row_number().over(w))
    kept = years.withColumn("enough", enough).withColumn("enough", F.min("enough").over(w)).where("enough").drop("enough")
    return kept.withColumn("gap", F.col("stayed") - F.col("gone"))
