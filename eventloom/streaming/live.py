"""Live feeds: late rows within a watermark, merged per batch, and running scores kept as state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATENESS = "21 days"


def counted(stream: DataFrame, at: str, kind: str, every: str = "1 day", lateness: str = LATENESS, key: str | None = None) -> DataFrame:
    """Events per window and kind, each key once if one is named; a window is final once the watermark has passed it."""
    marked = stream.withWatermark(at, lateness)
    if key is not None:
        marked = marked.dropDuplicatesWithinWatermark([key])
    return marked.groupBy(F.window(at, every).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def merge_into(path: str, key: str, at: str, partition: str):
    """A foreachBatch function: the newest row of each key wins, in the touched partitions only.

    A batch that runs again gives the same result.  A key whose partition changes leaves its old one; of
    rows of one key and time the greatest wins; columns that only one side has are null on the other.
    Errors are raised: only a path that does not exist counts as nothing stored yet.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        rows, touched = batch, batch.select(partition).distinct()
        if files.exists(place):
            stored = spark.read.option("mergeSchema", "true").parquet(path)
            moved = stored.join(batch.select(key).distinct(), key, "left_semi").select(partition).distinct()
            touched = touched.unionByName(moved).distinct()
            old = stored.join(touched, stored[partition].eqNullSafe(touched[partition]), "left_semi")
            rows = old.unionByName(batch, allowMissingColumns=True)
        order = F.struct(at, *[c for c in rows.columns if c != at])
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
        staged = f"{path.rstrip('/')}_staged_{uuid.uuid4().hex}"
        newest.write.parquet(staged)  # what is read cannot be overwritten at once
        kept = spark.read.schema(newest.schema).parquet(staged)
        # A partition that all its keys left has no rows to overwrite it with.
        emptied = [r[0] for r in touched.subtract(kept.select(partition)).select(F.col(partition).cast("string")).collect()]
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        for value in emptied:
            folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition, value)  # escaped as Spark writes it
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)

    return merge


SCORE = "game string, seq bigint, home int, away int"


def running_scores(stream: DataFrame) -> DataFrame:
    """Repaired scores of games in flight: per game the state is two numbers, whatever the length of the game.

    stream has game, seq, home, away; within a batch a game's rows are taken in order of seq.
    """

    def repair(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = list(state.get) if state.exists else [0, 0]
        rows = pd.concat(list(frames)).sort_values("seq")
        for i, side in enumerate(("home", "away")):
            rows[side] = rows[side].fillna(0).cummax().clip(lower=best[i]).astype("int32")
            best[i] = int(rows[side].iloc[-1])
        state.update(tuple(best))
        yield rows[["game", "seq", "home", "away"]]

    return stream.groupBy("game").applyInPandasWithState(repair, SCORE, "home int, away int", "append", GroupStateTimeout.NoTimeout)
