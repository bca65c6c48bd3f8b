"""Series that charts are drawn from.

Every function groups the plays of a lens once; shares are taken over the counted groups.  A rate has its
own count beside it, and groups with fewer plays than `least` are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import metrics as m
from eventloom.operators.lenses import CONVERSIONS

#: The group of an outcome of scrimmage plays, by lens.
GROUPS = {
    "off": {
        "Touchdown": "Touchdown", "First down": "First down", "Gain": "Gain", "No gain": "No gain or loss", "Loss": "No gain or loss", "Sack": "No gain or loss",
        "Incomplete": "Incomplete", "Penalty": "Penalty", "Turnover": "Turnover", "Turnover TD": "Turnover",
    },
    "def": {
        "Takeaway": "Takeaway", "Takeaway TD": "Takeaway", "Stop": "Stop", "Sack": "Stop", "Incomplete": "Incomplete",
        "Gain allowed": "Gain allowed", "First down allowed": "First down allowed", "Penalty": "Penalty", "TD allowed": "TD allowed",
    },
}


def phase(kind: str = "play_kind") -> Column:
    """The kick phase: three kinds are conversions."""
    return F.when(F.col(kind).isin(*CONVERSIONS), "conversion").otherwise(F.col(kind))


def attempt() -> Column:
    """How a conversion was tried."""
    kind, way = F.col("play_kind"), F.col("two_point_type")
    return F.when(kind == "pat", "kick").when(kind == "defensive_conversion", "return").when(way == "pass", "pass").when(way == "rush", "rush").otherwise("not stated")


def grouped(lens: str, outcome: str = "outcome") -> Column:
    pairs = [F.lit(x) for pair in GROUPS[lens].items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col(outcome)], F.lit("Unclassified"))


def mix(df: DataFrame, by: Sequence[str], parts: str = "outcome") -> DataFrame:
    """(by, parts, n, share): how the plays of each group divide."""
    return df.groupBy(*by, parts).agg(m.n().alias("n")).withColumn("share", m.share_of("n", *by))


def made_by_band(kicks: DataFrame, least: int = 10) -> DataFrame:
    """Field goals by band; one a penalty took back is no attempt."""
    own = kicks.where("play_kind = 'field_goal' AND kick_bucket IS NOT NULL AND outcome <> 'Negated'")
    return own.groupBy("kick_bucket").agg(m.n().alias("n"), m.n(F.col("outcome") == "Made").alias("made")).where(F.col("n") >= least).withColumn("rate", m.ratio("made", "n"))


def punts_by_position(punts: DataFrame, least: int = 200) -> DataFrame:
    """Gross and net by yards to goal at the snap, to the nearest ten (a five goes to the even ten)."""
    own = punts.where("play_kind = 'punt' AND yards_to_goal IS NOT NULL")
    band = (F.bround(F.col("yards_to_goal") / 10) * 10).cast("int")
    return own.groupBy(band.alias("band")).agg(m.n().alias("n"), m.mean("punt_gross_yds").alias("gross"), m.mean("punt_net_yds").alias("net")).where(F.col("n") >= least)


def conversions_by_season(kicks: DataFrame) -> DataFrame:
    """Extra points and two-point tries, each on its own attempts."""
    kind, good = F.col("play_kind"), F.col("outcome") == "Converted"
    counts = kicks.where(kind.isin(*CONVERSIONS)).groupBy("season").agg(
        m.n(kind == "pat").alias("kicks"), m.n((kind == "pat") & good).alias("kicks_good"), m.n(kind == "two_point").alias("twos"), m.n((kind == "two_point") & good).alias("twos_good"))
    return counts.withColumns({"kick_rate": m.ratio("kicks_good", "kicks"), "two_rate": m.ratio("twos_good", "twos")})


def kickoffs_by_season(kicks: DataFrame) -> DataFrame:
    """Shares of the kickoffs that were no onside kicks; what is not stated has a share of its own."""
    out = F.col("outcome")
    counts = kicks.where((F.col("play_kind") == "kickoff") & ~F.coalesce("onside", F.lit(False))).groupBy("season").agg(
        m.n().alias("n"), m.n(out == "Touchback").alias("touchbacks"), m.n(out == "Returned").alias("returns"), m.n(out == "Unknown").alias("unknowns"))
    return counts.select("season", "n", *[m.ratio(c, "n").alias(name) for c, name in (("touchbacks", "touchback_share"), ("returns", "return_share"), ("unknowns", "unknown_share"))])


def mean_distance(kicks: DataFrame) -> DataFrame:
    """Mean yards of a kick by season and phase; conversions have no distance."""
    return kicks.where("kick_yds IS NOT NULL").groupBy("season", phase().alias("phase")).agg(m.n().alias("n"), m.mean("kick_yds").alias("mean_yds"))


def trends(kicks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One measure for each phase and season, all phases in one pass; a season without a value is left out.

    Field goals: made of those not negated.  Punts: mean net.  Kickoffs: touchbacks of all.  Conversions: extra
    points alone, since a pooled rate would move with how often teams went for two.
    """
    out, kind = F.col("outcome"), F.col("play_kind")
    part = lambda test, of: m.n(test) / F.nullif(m.n(of), F.lit(0))
    value = (F.when(F.col("phase") == "field_goal", F.col("el_made")).when(F.col("phase") == "punt", F.col("el_net")).when(F.col("phase") == "kickoff", F.col("el_back")).otherwise(F.col("el_good")))
    sums = kicks.where(kind.isin("field_goal", "punt", "kickoff", "pat")).groupBy(*by, phase().alias("phase"), "season").agg(
        m.n().alias("n"), part(out == "Made", out != "Negated").alias("el_made"), m.mean("punt_net_yds").alias("el_net"), part(out == "Touchback", F.lit(True)).alias("el_back"), part(out == "Converted", F.lit(True)).alias("el_good"))
    return sums.select(*by, "phase", "season", "n", value.alias("value")).where("value IS NOT NULL")


def yards_by_down(plays: DataFrame) -> DataFrame:
    """Mean yards by down and kind, without turnovers: their yards are the other side's return."""
    own = plays.where((F.col("down").between(1, 4)) & ~F.coalesce("is_turnover", F.lit(False)) & F.col("yards").isNotNull())
    return own.groupBy("down", "play_kind").agg(m.n().alias("n"), m.mean("yards").alias("mean_yards"))
