"""Target-distribution importance resampling over hashed word runs.

Every run of words falls into one of many buckets.  Documents become inverted postings, (bucket, rows,
counts) blocks packed batch by batch; the blocks are shuffled by bucket together with the two corpora's
totals of each bucket, so a bucket's gain (how much likelier it is in the target) is computed where its
postings lie.  Tasks emit contributions, summed by document and packed as the postings were, and a second
shuffle by pack sums them: a pack's contributions are never more than its postings.  Adding Gumbel noise that the id decides and taking the highest scores draws documents
without replacement in proportion to their importance weights.

A bucket may hold a third of all postings: blocks carry a salt, and a bucket's totals go to each salt.

Defined results: a null or empty text has no run and a weight of 0; a null id is written as nothing in the
noise's key; repeated rows are scored each and are told apart only by the last tie-break; texts are read
whole; with an empty target every bucket's gain comes from the documents alone; an empty table gives an
empty result.  Only the named columns are read, so clashing names do no harm.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ranked, released, saved, small_batches

#: Words a run has at most, buckets, seed of the noise, words a document needs to be drawn, percent drawn.
LONGEST, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
#: Parts a bucket's postings are dealt into; bytes of texts whose postings are packed together; contributions summed together.
SALTS, PACKED_BYTES, SUMMED = 8, 8 << 20, 1_000_000
#: Row numbers are a pack's number and this many bits for the row in it (a pack has PACKED_BYTES / 100 rows at most).
PACK_BITS = 17
#: Bytes of a text read at once; runs whose bucket a task remembers.
SLICE_BYTES, KNOWN_RUNS = 1 << 20, 200_000
#: Word bytes stay, A-Z become lower case, all other ASCII becomes a blank.
_plain = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_slices(raw: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, a slice of it at a time."""
    raw, a = (raw or b"").translate(_plain), 0
    while a < len(raw):
        b = raw.find(b" ", a + SLICE_BYTES)
        b = len(raw) if b < 0 else b
        yield raw[a:b].split()
        a = b


def bucket_counts(raw: bytes | None, longest: int, buckets: int, known: dict[bytes, int]) -> tuple[int, Counter]:
    """(number of words, how many runs of up to longest words fall into each bucket).  known keeps runs' buckets, a bounded number."""
    n_words, found, tail = 0, Counter(), []
    for own in word_slices(raw):
        words = tail + own
        for n in range(1, longest + 1):
            first = max(len(tail) - n + 1, 0)  # runs that end in this slice
            runs = Counter(own if n == 1 else (b" ".join(words[i:i + n]) for i in range(first, len(words) - n + 1)))
            for run, times in runs.items():
                b = known.get(run)
                if b is None:
                    if len(known) >= KNOWN_RUNS:
                        known.clear()
                    b = known[run] = zlib.crc32(run) % buckets
                found[b] += times
        n_words += len(own)
        tail = words[max(len(words) - longest + 1, 0):]
    return n_words, found


def postings(docs: DataFrame, doc_id: str, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Rows of two sorts: documents (row, doc_id, n_words, n_features) and blocks (bucket, rows, counts).

    row numbers a document; the result has to be saved before it is read twice.
    """
    names = ["row", "doc_id", "n_words", "n_features", "bucket", "rows", "counts"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, id_kind = TaskContext.get().partitionId() << 23, {}, None
        row = part << PACK_BITS
        heads: list[tuple] = []
        flat: list[np.ndarray] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            cols = [pa.array(c, k) for c, k in zip(list(zip(*heads, strict=True)) or [()] * 4, (pa.int64(), id_kind, pa.int64(), pa.int64()), strict=True)]
            none = len(heads)
            lists = lambda: pa.nulls(none, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*cols, pa.nulls(none, pa.int32()), lists(), lists()], names=names)
            if flat:
                all_ = np.concatenate(flat, axis=1)
                all_ = all_[:, np.argsort(all_[0], kind="stable")]
                starts = np.flatnonzero(np.diff(all_[0], prepend=-1))
                ends = pa.array(np.append(starts, all_.shape[1]).astype(np.int32))
                n = len(starts)
                own = [pa.nulls(n, pa.int64()), pa.nulls(n, id_kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(all_[0][starts].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(ends, pa.array(all_[1])), pa.ListArray.from_arrays(ends, pa.array(all_[2]))], names=names)

        for batch in batches:
            id_kind = batch.column(0).type
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = raw.as_py() or b""
                row += 1
                n, found = bucket_counts(raw, longest, buckets, known)
                heads.append((row, name, n, found.total()))
                if found:
                    flat.append(np.array([list(found), [row] * len(found), list(found.values())], np.int64))
                size += len(raw) + 100
                if size > PACKED_BYTES:
                    yield from sent()
                    heads, flat, size = [], [], 0
                    part += 1
                    row = part << PACK_BITS
        if heads:
            for part in sent():
                yield released(part)

    kind = docs.schema[doc_id].dataType.simpleString()
    raw = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("raw"))
    return raw.mapInArrow(pack, f"row bigint, doc_id {kind}, n_words bigint, n_features bigint, bucket int, rows array<bigint>, counts array<bigint>")


def bucket_sums(packed: DataFrame) -> DataFrame:
    """(bucket, held): the runs that a corpus has in each bucket, at most one row a bucket."""
    own = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return packed.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum(own).alias("held"))


def gain(s: Column, t: Column, s_all: Column, t_all: Column, buckets: int) -> Column:
    """A bucket's gain, in thousandths of the log of the ratio of smoothed shares."""
    up, down = (t + 1).cast("double") * (s_all + buckets).cast("double"), (s + 1).cast("double") * (t_all + buckets).cast("double")
    return F.floor(F.lit(1000.0) * F.log(up / down)).cast("long")


def noise(doc_id: str | Column, seed: int = SEED) -> Column:
    """Gumbel noise that the id and the seed decide, in thousandths."""
    name = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in order, the sum of each one's values)."""
    kept, at = np.unique(rows, return_inverse=True)
    sums = np.zeros(len(kept), np.int64)
    np.add.at(sums, at, values)
    return kept, sums


def weighted(packed: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight) of saved postings; target is bucket_sums() of the target's."""
    source = bucket_sums(packed).select("bucket", F.col("held").alias("s"), F.lit(0).cast("bigint").alias("t"))
    both = source.unionByName(target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("held").alias("t"))).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    both = saved(both)
    s_all, t_all = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    totals = both.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    blocks = packed.where("bucket IS NOT NULL").select("bucket", F.pmod(F.xxhash64(F.col("rows")[0]), F.lit(SALTS)).cast("int").alias("salt"), "rows", "counts")
    dealt = blocks.hint("shuffle_hash").join(totals.hint("shuffle_hash"), ["bucket", "salt"]).select("rows", "counts", gain(F.col("s"), F.col("t"), F.lit(s_all), F.lit(t_all), buckets).alias("gain"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sent() -> pa.RecordBatch:
            rows, sums = by_row(np.concatenate([r for r, _ in held]), np.concatenate([v for _, v in held]))
            packs = rows >> PACK_BITS
            starts = np.flatnonzero(np.diff(packs, prepend=-1))
            ends = pa.array(np.append(starts, len(rows)).astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(packs[starts]), pa.ListArray.from_arrays(ends, pa.array(rows)), pa.ListArray.from_arrays(ends, pa.array(sums))], names=["pack", "rows", "weights"])

        for batch in batches:
            rows, counts = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            lengths = np.diff(batch.column(0).offsets.to_numpy())
            held.append((rows, counts * np.repeat(batch.column(2).to_numpy(), lengths)))
            size += len(rows)
            if size > SUMMED:
                yield sent()
                held, size = [], 0
        if held:
            yield released(sent())

    def reduce(parts: pa.Table) -> pa.Table:
        flat = [pa.concat_arrays([c.flatten() for c in parts.column(name).chunks]).to_numpy() for name in ("rows", "weights")]
        return pa.table(dict(zip(("row", "weight"), by_row(*flat), strict=True)))

    sums = dealt.mapInArrow(emit, "pack bigint, rows array<bigint>, weights array<bigint>").groupBy("pack").applyInArrow(reduce, "row bigint, weight bigint")
    none = F.lit(None)
    kind = packed.schema["doc_id"].dataType
    parts = packed.where("row IS NOT NULL").select("row", "doc_id", "n_words", "n_features", F.lit(0).cast("bigint").alias("weight")).unionByName(
        sums.select("row", none.cast(kind).alias("doc_id"), none.cast("bigint").alias("n_words"), none.cast("bigint").alias("n_features"), "weight")
    )
    return parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("n_features").alias("n_features"), F.sum("weight").alias("weight"))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is null where the row isn't drawn."""
    packed = saved(postings(docs, doc_id, text, longest, buckets))
    aim = bucket_sums(postings(target.select(F.lit(0).alias("el_id"), F.col(target_text).alias("el_text")), "el_id", "el_text", longest, buckets))
    rows = saved(weighted(packed, aim, buckets).withColumn("score", F.col("weight") + noise("doc_id", seed)))
    fit = rows.where(F.col("n_words") >= least_words).select("row", "doc_id", "score")
    drawn = fit.count() * percent // 100
    placed = ranked(fit, [], [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")], "place", "el_range").where(F.col("place") < drawn)
    return rows.join(placed.select("row", (F.col("place") + 1).alias("rank")), "row", "left").select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
