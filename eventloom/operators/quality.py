"""Data-quality checks: each returns the rows that fail, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_unique(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nulls_in(df: DataFrame, *columns: str) -> DataFrame:
    """(column, n) of columns that hold nulls: one pass for all of them."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n").where("n > 0")


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list; null is not a value."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def unrelated(df: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)), column, "left_anti")


def counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, n): rows for which each rule holds, zero included; one pass for all of them.  A rule that is unknown does not hold."""
    names = {f"el_{i}": name for i, name in enumerate(rules)}
    counts = df.agg(*[F.count(F.when(rule, 1)).alias(c) for c, rule in zip(names, rules.values(), strict=True)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.col(c).alias("n")) for c, name in names.items()])))


def orphans(df: DataFrame, links: dict[str, tuple[Sequence[str], DataFrame, Sequence[str]]]) -> DataFrame:
    """(check, keys, n, bad_keys, bad_n) of each link (columns, parents, their key): distinct keys and rows that name one, and those no parent has.

    One scan of df for all links.  Rows are counted by key before parents are joined, so a key that most rows
    share is one row there.  Rows with a null in a key name no parent and are not counted; a link that no row
    names has no row in the result.
    """
    key = lambda columns: F.when(F.greatest(F.lit(False), *[F.col(c).isNull() for c in columns]), None).otherwise(F.to_json(F.array(*[F.col(c).cast("string") for c in columns])))
    named = F.inline(F.array(*[F.struct(F.lit(name).alias("check"), key(columns).alias("key")) for name, (columns, _, _) in links.items()]))
    rows = df.select(named).where("key IS NOT NULL").groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for name, (_, parents, columns) in links.items():
        part = parents.select(F.lit(name).alias("check"), key(columns).alias("key"))
        known = part if known is None else known.unionByName(part)
    both = rows.join(known.where("key IS NOT NULL").distinct().withColumn("known", F.lit(True)), ["check", "key"], "left")
    bad = F.col("known").isNull()
    return both.groupBy("check").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("n").alias("n"), F.count(F.when(bad, 1)).alias("bad_keys"), F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("bad_n"),
    )


def failing(df: DataFrame, rule: Column) -> DataFrame:
    """Rows where the rule is false or unknown."""
    return df.where(~F.coalesce(rule, F.lit(False)))


def verdict(n: int, warn: int = 0, error: int = 0) -> str:
    """A ratchet: known failures warn, more than those are errors."""
    return "error" if n > error else "warn" if n > warn else "pass"


def not_monotonic(df: DataFrame, by: str, value: str, falling: bool = True) -> DataFrame:
    """Groups whose value does not go on falling (rising).  df has one row per group."""
    before = F.lag(value).over(Window.orderBy(by))
    return df.withColumn("before", before).where(F.col(value) > F.col("before") if falling else F.col(value) < F.col("before"))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with multiplicity."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def checksum(df: DataFrame, *columns: str) -> DataFrame:
    """(n, sum): independent of the order of rows and of their partitions."""
    row = F.md5(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(number), F.lit(0)).alias("sum"))


def row_counts(**tables: DataFrame) -> DataFrame:
    """(name, n) of each table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_difference(a: DataFrame, b: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """(column, type in a, type in b) where they differ."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return [(c, x.get(c), y.get(c)) for c in sorted(x.keys() | y.keys()) if x.get(c) != y.get(c)]


def stale(df: DataFrame, at: str, as_of: str, days: int) -> DataFrame:
    """One row if the newest row is older than so many days at as_of."""
    return df.agg(F.max(at).alias("newest")).where(F.coalesce(F.col("newest") < F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS"), F.lit(True)))
