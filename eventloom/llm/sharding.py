"""Fixed virtual slots: records hash into thousands of slots, and a versioned table maps slots to shards.

A record never changes its slot; only the map is edited.  Growing by one shard writes a new version
of the map in which every old shard gives an equal number of slots to the new one, so rows move only
into the new shard.  Rebalancing writes a new version in which slots of the heaviest shards move to
the lightest ones, by the bytes aggregated per slot.

Defined results: a null key is a key like any other; a null text weighs 0 bytes (plus the one byte
each record costs); texts are weighed whole, however long; repeated rows each get a place, ties in any
order; all records of one key share a slot by the law, so only they are ordered together; an empty table
gives an empty result.  Columns other than the named ones are not read, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Virtual slots.  Fixed for the life of a data set: a record's slot must never change.
N_SLOTS = 4096


def slot_of(key: str | Column, n_slots: int = N_SLOTS) -> Column:
    """The virtual slot of a key: the key's hash alone decides."""
    col = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(col), F.lit(n_slots)).cast("int")


def first_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Version 1 of the map: slots dealt round over the shards."""
    slot = F.col("id").cast("int")
    return spark.range(n_slots).select(F.lit(1).alias("version"), slot.alias("vslot"), F.pmod(slot, F.lit(n_shards)).alias("shard"))


def grown_map(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version, for one shard more than the n_shards of slot_map.

    Every old shard gives its share of slots (the first by the slots' hash) to shard number
    n_shards; no slot moves between old shards.  Keys and the number of shards alone decide.
    """
    held = Window.partitionBy("shard")
    place = F.row_number().over(held.orderBy(F.xxhash64("vslot"), "vslot"))
    gives = place <= F.floor(F.count(F.lit(1)).over(held) / F.lit(n_shards + 1))
    return slot_map.select((F.col("version") + 1).alias("version"), "vslot", F.when(gives, F.lit(n_shards)).otherwise(F.col("shard")).alias("shard"))


def slot_bytes(records: DataFrame, key: str, text: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Rows and bytes per virtual slot: at most n_slots rows, pre-aggregated before the shuffle."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    return records.groupBy(slot_of(key, n_slots).alias("vslot")).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))


def rebalanced_map(slot_map: DataFrame, weights: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """The next version after moving slots from shards above the mean to shards below it.

    weights is slot_bytes(); both tables have at most n_slots rows.  Each shard heavier than
    (1 + tolerance) of the mean offers its last slots, the part above the mean; each lighter shard
    has room up to the mean; offers and room are laid on one line of bytes, and an offered slot goes
    to the shard whose room its midpoint falls in.
    """
    held = slot_map.join(weights, "vslot", "left").select("version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(1))) / F.size(F.collect_set("shard").over(Window.partitionBy(F.lit(1))))
    within = Window.partitionBy("shard")
    ranked = held.withColumn("mean", mean).withColumn("total", F.sum("bytes").over(within)).withColumn("upto", F.sum("bytes").over(within.orderBy("vslot")))
    offered = (F.col("total") > F.col("mean") * (1 + tolerance)) & (F.col("upto") - F.col("bytes") / 2 > F.col("mean"))
    ranked = ranked.withColumn("offered", offered)
    room = (
        ranked.groupBy("shard").agg(F.max(F.col("mean") - F.col("total")).alias("room")).where("room > 0")
        .withColumn("room_to", F.sum("room").over(Window.partitionBy(F.lit(1)).orderBy("shard")))
        .select(F.col("shard").alias("to_shard"), (F.col("room_to") - F.col("room")).alias("room_from"), "room_to")
    )
    line = Window.partitionBy(F.lit(1)).orderBy("shard", "vslot")
    moves = ranked.where("offered").withColumn("at", F.sum("bytes").over(line) - F.col("bytes") / 2)
    moved = moves.join(F.broadcast(room), (F.col("at") >= F.col("room_from")) & (F.col("at") < F.col("room_to"))).select("vslot", "to_shard")
    return slot_map.join(F.broadcast(moved), "vslot", "left").select((F.col("version") + 1).alias("version"), "vslot", F.coalesce("to_shard", "shard").alias("shard"))


def placed(records: DataFrame, slot_map: DataFrame, key: str, text: str, n_slots: int = N_SLOTS) -> DataFrame:
    """(key, size, text_crc32, vslot, shard, slot): each record's shard and its gapless place in it.

    A place is the rows of the shard's earlier virtual slots plus the place within the record's own
    virtual slot, so the only ordering work is within one of the thousands of virtual slots and no
    task holds a whole shard.  Texts never cross the network.
    """
    vslot = slot_of(key, n_slots)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slot_map.join(F.broadcast(slot_bytes(records, key, text, n_slots)), "vslot", "left")
        .select("vslot", "shard", F.coalesce(F.sum(F.coalesce("rows", F.lit(0))).over(before), F.lit(0)).alias("starts"))
    )
    narrow = records.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        vslot.alias("vslot"),
    )
    own = F.row_number().over(Window.partitionBy("vslot").orderBy(key, "text_crc32", "size"))
    return (
        narrow.withColumn("own", own).join(F.broadcast(starts), "vslot")
        .select(key, "size", "text_crc32", "vslot", "shard", (F.col("starts") + F.col("own") - 1).alias("slot"))
    )
