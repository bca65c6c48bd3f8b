"""Load semantics: guards that stop a bad load, scoped replacement, merges, published versions."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class LoadRefused(ValueError):
    """A guard found the staged rows unfit to replace what is stored."""


def refuse_empty(staged: DataFrame) -> DataFrame:
    if staged.isEmpty():
        raise LoadRefused("the staged table is empty")
    return staged


def refuse_orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    n = rows.join(parents, key, "left_anti").count()
    if n:
        raise LoadRefused(f"{n} rows name a {key} that is not there")
    return rows


def refuse_strays(rows: DataFrame, column: str, value) -> DataFrame:
    n = rows.where(~F.col(column).eqNullSafe(F.lit(value))).count()
    if n:
        raise LoadRefused(f"{n} rows are not of {column} {value}")
    return rows


def refuse_gaps(stored: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    n = stored.join(staged, key, "left_anti").count()
    if n:
        raise LoadRefused(f"the staged table lacks {n} of the stored rows")
    return staged


def replace_partitions(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that rows hold; running it twice changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def upserted(stored: DataFrame, news: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both; where both know a row, each column takes the new value unless that is null.

    A statement that would touch a row twice, or a row without a key, is refused.
    """
    rest = [c for c in stored.columns if c not in key]
    known = F.lit(True)
    for k in key:
        known &= F.col(k).isNotNull()
    if not news.where(~known).isEmpty():
        raise LoadRefused("a new row has no key")
    if not news.groupBy(*key).count().where("count > 1").isEmpty():
        raise LoadRefused("two new rows have one key")
    renamed = news.select(*key, *[F.col(c).alias(f"el_new_{c}") for c in rest])
    return stored.join(renamed, list(key), "full_outer").select(*key, *[F.coalesce(f"el_new_{c}", c).alias(c) for c in rest])


def inserted_new(stored: DataFrame, news: DataFrame, key: Sequence[str]) -> DataFrame:
    """stored and the rows of news whose key is not in it, one per key."""
    return stored.unionByName(news.join(stored, list(key), "left_anti").dropDuplicates(list(key)))


def refreshed(facts: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """facts with columns taken anew from source (null where source has no row)."""
    return facts.drop(*columns).join(source.select(key, *columns), key, "left")


def reparsed(stored: DataFrame, staged: DataFrame, key: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(stored with columns taken anew from staged, the values that it had before where they change).

    Refused unless staged has every stored row; other columns and rows stay.  The second frame undoes it.
    """
    refuse_gaps(stored, staged, key)
    new = staged.select(key, F.struct(*columns).alias("el_new"))
    both = stored.join(new, key).withColumn("el_old", F.struct(*columns))
    changed = both.where(~F.col("el_old").eqNullSafe(F.col("el_new"))).select(key, "el_old.*")
    return both.withColumns({c: F.col(f"el_new.{c}") for c in columns}).select(stored.columns), changed


def undone(current: DataFrame, before: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """current with the values of before, the second frame that reparsed() gave."""
    old = before.select(key, F.struct(*columns).alias("el_old"))
    back = {c: F.when(F.col("el_old").isNull(), F.col(c)).otherwise(F.col(f"el_old.{c}")) for c in columns}
    return current.join(old, key, "left").withColumns(back).select(current.columns)


def reparse(spark: SparkSession, name: str, staged: DataFrame, key: str, columns: Sequence[str]) -> str:
    """reparsed() of a published table: the new version is published, the old values are stored beside it.  Gives the name to undo by."""
    new, before = reparsed(spark.table(name), staged, key, columns)
    undo = f"{name}_undo_{time.time_ns()}"
    before.write.saveAsTable(undo)
    publish(spark, new, name)
    return undo


def undo_reparse(spark: SparkSession, name: str, undo: str, key: str) -> str:
    """Publish the table as it was before reparse(); rows loaded since then stay."""
    before = spark.table(undo)
    return publish(spark, undone(spark.table(name), before, key, [c for c in before.columns if c != key]), name)


MANIFEST = "current.json"


def publish_together(frames: Mapping[str, DataFrame], base: str) -> str:
    """Write frames that belong together (a fact and its bridge), then name all of them in one manifest.

    Readers follow the manifest, which is replaced by one rename: they see all of the old or all of the new
    frames, and a writer that dies in between leaves the old ones shown.
    """
    spark = next(iter(frames.values())).sparkSession
    version = f"v{time.time_ns()}"
    for name, df in frames.items():
        df.write.parquet(f"{base}/{version}/{name}")
    jvm = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    staged, place = jvm.Path(f"{base}/{version}/{MANIFEST}"), jvm.Path(f"{base}/{MANIFEST}")
    files = jvm.FileContext.getFileContext(staged.toUri(), conf)
    out = staged.getFileSystem(conf).create(staged)
    out.write(bytearray(json.dumps({name: f"{version}/{name}" for name in frames}).encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    overwrite[0] = jvm.Options.Rename.OVERWRITE
    files.rename(staged, place, overwrite)
    return version


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The frames that the manifest names."""
    text = spark.read.text(f"{base}/{MANIFEST}", wholetext=True).first()[0]
    return {name: spark.read.parquet(f"{base}/{path}") for name, path in json.loads(text).items()}


def publish(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write df as a table of its own, then let the view name show it: readers see the old or the new rows, whole.

    The view is replaced in one step.  The version shown before stays for those who read it still, and for
    going back; older ones are dropped.  Gives the new version's table.
    """
    version = f"{name}_v{time.time_ns()}"
    df.write.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    database, _, base = name.rpartition(".")
    known = spark.catalog.listTables(database or None, f"{base}_v*")
    versions = sorted(t.name for t in known if re.fullmatch(rf"{re.escape(base.lower())}_v\d+", t.name.lower()))
    for stale in versions[:-2]:
        spark.sql(f"DROP TABLE {database + '.' if database else ''}{stale}")
    return version


def missing_events(known: DataFrame, loaded: DataFrame, key: str, since: str, at: str) -> DataFrame:
    """Finished events of the lookback that are not loaded yet."""
    return known.where(F.col(at) >= F.lit(since).cast("timestamp")).join(loaded, key, "left_anti")
