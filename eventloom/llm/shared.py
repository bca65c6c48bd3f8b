"""Helpers the training-data operators share: tables, the shared folder, the size check before a broadcast."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its rows, measured and not estimated, need no more than this.
BROADCAST_BYTES = 32 << 20

#: Rows of an Arrow batch at most: texts may be long, and a worker holds a batch and what it makes of it.
BATCH_ROWS = 2_000

_made: list[str] = []


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors both see, below spark.checkpoint.dir.

    Only where that setting is absent and Spark runs in one process (tests, a laptop) is a local temporary
    folder used; on a cluster its absence is an error, as executors would not find what others wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='eventloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/eventloom-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def discard(spark: SparkSession) -> int:
    """Delete what this process has saved so far, once the results that read it are written.  Gives the number of folders."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), len(_made)
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def saved(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: short lineage that outlives any executor."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """df, after its session was told to send workers at most BATCH_ROWS rows at once (if it was not told to send fewer)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def released(result: pa.Array) -> pa.Array:
    """result, after memory that Arrow keeps for later was given back: other operators may use the worker next."""
    pa.default_memory_pool().release_unused()
    return result


_state: dict = {}


def worker_state(key: tuple, build: Callable):
    """What build() gives, kept in a worker process until another key is asked for.

    A worker serves one operator after another; what one keeps is dropped before the next builds its own.
    """
    if key not in _state:
        _state.clear()
        gc.collect()
        _state[key] = build()
    return _state[key]


def broadcast_if_small(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if the measured sum of row_bytes is within limit, else df as it is.

    df must be a saved table, as this runs a job over it.
    """
    total = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if total <= limit else df


def ranked(df: DataFrame, by: list[str], order: list[str | Column], rank: str, part: str) -> DataFrame:
    """df, saved, with the place (from 0, a long) that each row has among the rows of its group, under the name rank.

    A group may be larger than a task: rows are dealt by ranges of (by, order), each range numbers its own
    rows, and the rows of a group's earlier ranges are added from a table of one row a range and group.
    part names a column for the range; both names must be new to df.
    """
    from pyspark.sql import Window

    kept = saved(df.repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = saved(kept.groupBy(part, *by).agg(F.count(F.lit(1)).alias("el_rows")).withColumn("el_before", F.coalesce(F.sum("el_rows").over(before), F.lit(0)))).select(F.col(part).alias("el_part"), *(F.col(c).alias(f"el_by{i}") for i, c in enumerate(by)), "el_before")
    same = F.col(part) == F.col("el_part")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"el_by{i}"))
    own = F.row_number().over(Window.partitionBy(part, *by).orderBy(*order)) - 1
    return kept.withColumn(rank, own).join(broadcast_if_small(sizes, F.lit(64)), same).withColumn(rank, F.col(rank) + F.col("el_before")).select(*df.columns, rank)
