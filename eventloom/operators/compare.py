"""Two copies of a table compared by mergeable checksums: which columns differ, and of which rows.

Every value is hashed with its row's key, and the hashes are summed by column and bucket of keys; sums of
buckets add up to those of larger buckets and of the table.  Both sides are read once for that, and only
rows of the buckets that differ are read again and laid beside each other.  No order of rows, no
partitioning and no join of whole tables is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _text(column: str) -> Column:
    """A value as text; null is told from every text."""
    return F.coalesce(F.concat(F.lit("v"), F.col(column).cast("string")), F.lit("null"))


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS, by: Sequence[str] = ()) -> DataFrame:
    """(by, bucket, n, and a sum of hashes for each column): at most so many rows for each of by, summed before the shuffle."""
    name = F.concat_ws("\x1f", *[_text(k) for k in key])
    number = lambda c: F.xxhash64(name, _text(c)).cast("decimal(38,0)")
    return df.groupBy(*by, _bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(number(c)).alias(c) for c in columns])


def merged(sums: DataFrame, columns: Sequence[str], factor: int) -> DataFrame:
    """The sums of larger buckets, factor of them put together."""
    return sums.groupBy(F.floor(F.col("bucket") / factor).cast("int").alias("bucket")).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])


def differing(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(bucket, columns): the buckets whose sums differ and the columns that do; a bucket that one side lacks differs in all."""
    x, y = a.select("bucket", F.struct("n", *columns).alias("x")), b.select("bucket", F.struct("n", *columns).alias("y"))
    return _differing(x.join(y, "bucket", "full_outer"), columns)


def _differing(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    own = F.array(*[F.when(~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")), F.lit(c)) for c in columns])
    both = both.withColumn("columns", F.filter(own, lambda c: c.isNotNull()))
    return both.where((F.size("columns") > 0) | ~F.col("x.n").eqNullSafe(F.col("y.n"))).select("bucket", "columns")


def differences(a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(key, column, found, in_a, in_b): every value that differs, as text; found is both, a or b (rows that one side lacks have no column).

    Keys are unique on each side.
    """
    open_ = F.broadcast(differing(bucket_sums(a, key, columns, buckets), bucket_sums(b, key, columns, buckets), columns).select("bucket"))  # so many rows at most
    side = lambda df, name: df.select(*key, _bucket(key, buckets).alias("bucket"), F.lit(name).alias("side"), F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("v")).join(open_, "bucket", "left_semi")
    return _told(side(a, "a").unionByName(side(b, "b")), key, columns)


def differences_of(sides: DataFrame, key: Sequence[str], columns: Sequence[str], tasks: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """differences() of two copies that come from one frame: sides has a column side, a or b.

    The frame is computed once: its rows are dealt by key, and both the sums and the rows of the buckets that differ
    are read from that shuffle.
    """
    keys = [F.col(k) for k in key]
    dealt = sides.select(*key, "side", *columns)
    dealt = dealt.repartition(tasks, *keys) if tasks else dealt.repartition(*keys)
    sums = bucket_sums(dealt, key, columns, buckets, ["side"])
    both = sums.groupBy("bucket").agg(*[F.max(F.when(F.col("side") == s, F.struct("n", *columns))).alias(out) for s, out in (("a", "x"), ("b", "y"))])
    open_ = F.broadcast(_differing(both, columns).select("bucket"))  # so many rows at most
    rows = dealt.select(*key, _bucket(key, buckets).alias("bucket"), "side", F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("v"))
    return _told(rows.join(open_, "bucket", "left_semi"), key, columns)


def _told(sides: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    rows = sides.groupBy(*key).agg(*[F.max(F.when(F.col("side") == s, F.struct(F.lit(1).alias("is"), F.col("v").alias("v")))).alias(s) for s in ("a", "b")])
    found = F.when(F.col("a").isNull(), "b").when(F.col("b").isNull(), "a").otherwise("both")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a.v.{c}").alias("in_a"), F.col(f"b.v.{c}").alias("in_b")) for c in columns])
    none = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("column", "in_a", "in_b")]))
    told = F.when(found == "both", F.filter(pairs, lambda p: ~p["in_a"].eqNullSafe(p["in_b"]))).otherwise(none)
    return rows.select(*key, found.alias("found"), F.inline(told)).select(*key, "column", "found", "in_a", "in_b")
