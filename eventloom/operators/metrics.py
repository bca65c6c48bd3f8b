"""Measures with the denominators they belong on, and what is built from them.

A rate pools counts over counts; a flag that is not stated is in neither count.  Sums and counts
combine on the map side, so every function here shuffles one row per group and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def n(test: Column | None = None) -> Column:
    """count(*) of the rows where test holds."""
    return F.count(F.lit(1)) if test is None else F.count(F.when(test, F.lit(1)))


def total(value: str | Column, test: Column | None = None) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.sum(c if test is None else F.when(test, c))


def mean(value: str | Column, test: Column | None = None) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.avg(c if test is None else F.when(test, c))


def top(value: str, test: Column | None = None) -> Column:
    return F.max(value if test is None else F.when(test, F.col(value)))


def percent(flag: str | Column, test: Column | None = None) -> Column:
    """100 times the mean of a tri-state flag; nulls drop out."""
    c = (F.col(flag) if isinstance(flag, str) else flag).cast("int")
    return 100.0 * F.avg(c if test is None else F.when(test, c))


def ratio(a: str, b: str) -> Column:
    return F.col(a) / F.nullif(F.col(b), F.lit(0))


def modal(value: str, weight: str) -> Column:
    """The value of most weight; of equal ones the greatest value, so runs agree."""
    return F.max_by(value, F.struct(F.col(weight), F.col(value)))


def arg_max(value: str, key: Sequence[str], test: Column) -> Column:
    """The value of the greatest key among the rows where test holds and value is known."""
    return F.max_by(value, F.when(test & F.col(value).isNotNull(), F.struct(*key)))


def share_of(column: str, *partition: str) -> Column:
    """A row's share of its partition's sum."""
    return F.col(column) / F.sum(column).over(Window.partitionBy(*partition))


def text_list(column: str, between: str = " · ") -> Column:
    """Distinct values in order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(column)), between)


SNAPS = ("rush", "pass", "sack")


def kick_measures() -> dict[str, Column]:
    kind, out = F.col("play_kind"), F.col("outcome")
    return {
        "kicks": n(), "first_season": F.min("season"), "last_season": F.max("season"), "games": F.countDistinct("game_id"),
        "fg_att": n((kind == "field_goal") & (out != "Negated")), "fg_made": n(out == "Made"), "fg_long": top("fg_distance_yds", out == "Made"),
        "punts": n(kind == "punt"), "punt_gross": mean("punt_gross_yds"), "punt_net": mean("punt_net_yds"),
        "kickoffs": n(kind == "kickoff"), "ko_dist": mean("kickoff_yds"), "ko_denom": n((kind == "kickoff") & ~F.coalesce("onside", F.lit(False))), "touchbacks": n(out == "Touchback"),
        "pat_att": n(kind == "pat"), "pat_made": n((kind == "pat") & (out == "Converted")), "pat_blocked": n((kind == "pat") & (out == "Blocked")),
        "two_att": n(kind == "two_point"), "two_made": n((kind == "two_point") & (out == "Converted")), "def_conv": n(kind == "defensive_conversion"), "unknowns": n(out == "Unknown"),
    }


KICK_RATES = {"fg_rate": ("fg_made", "fg_att"), "tb_rate": ("touchbacks", "ko_denom"), "pat_rate": ("pat_made", "pat_att"), "two_rate": ("two_made", "two_att"), "unk_share": ("unknowns", "kicks")}


def scrimmage_measures() -> dict[str, Column]:
    kind = F.col("play_kind")
    kept = kind.isin(*SNAPS) & ~F.coalesce("is_turnover", F.lit(False))
    return {
        "plays": n(), "first_season": F.min("season"), "last_season": F.max("season"), "games": F.countDistinct("game_id"), "snaps": n(kind.isin(*SNAPS)),
        "ypp": mean("yards", kept), "yards_total": total("yards", kept), "first_downs": n(F.col("first_down_gained")), "tds": n(F.col("is_touchdown")), "turnovers": n(F.col("is_turnover")),
        "sacks": n(kind == "sack"), "rushes": n(kind == "rush"), "passes": n(kind == "pass"), "completions": n(F.col("is_complete")), "penalties": n(kind == "penalty"),
    }


SCRIMMAGE_RATES = {"fd_rate": ("first_downs", "snaps"), "comp_rate": ("completions", "passes"), "to_rate": ("turnovers", "snaps")}


def rolled_up(df: DataFrame, by: Sequence[str], measures: dict[str, Column], rates: dict[str, tuple[str, str]] | None = None, **labels: Column) -> DataFrame:
    """Measures by group, then the rates derived from them."""
    grouped = df.groupBy(*by).agg(*[c.alias(k) for k, c in (measures | labels).items()])
    return grouped.withColumns({k: ratio(a, b) for k, (a, b) in (rates or {}).items()})


def leaders(wide: DataFrame, athletes: DataFrame, player: str, measures: dict[str, Column], least: int, count: str, order: Sequence[str], limit: int) -> DataFrame:
    """Ranked players with at least so many attempts: aggregated first, then joined to their names, then the top rows."""
    sums = wide.where(F.col(player).isNotNull()).groupBy(F.col(player).alias("athlete_id")).agg(*[c.alias(k) for k, c in measures.items()]).where(F.col(count) >= least)
    named = sums.join(athletes.select("athlete_id", "known_name", "position"), "athlete_id")
    return named.orderBy(*[F.col(c).desc_nulls_last() for c in order], "athlete_id").limit(limit)
