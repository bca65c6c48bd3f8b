"""Token ids on disk as Re-Pair grammars.

A data set is a Parquet table with one row per shard: documents in ascending id order, their token
counts, the rules that replaced frequent id pairs, the expansion length of every rule, and the
sequence that is left.  A rule's two sides are ids or earlier rules (numbered on from RULE_BASE), so
any document is decoded on its own: running sums of expansion lengths give the symbols that cover it.

Re-Pair replaces the most frequent pair, over and over.  Here a round counts the pairs that may be
frequent by one sort, takes those within a factor of the most frequent one, and replaces them together
(where two overlap, the more frequent one wins); rounds go on until no pair pays for its rule.

Defined results: a null or empty text is stored as its end id alone; null document ids come first;
documents of one id are ordered by the text's hash; repeated rows are stored each; a document is never
split over shards, so a very long one closes the shard it is in; an empty table gives an empty data
set.  Only the named columns are read, so others' names do no harm.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import broadcast_if_small, saved, small_batches, worker_state
from .words import LITERAL, Store, encoded, gathered_ids, list_array, unit_text

SHARD_TOKENS = 1 << 18
RULE_BASE = 1 << 20
#: A pair this frequent in a shard becomes a rule (a rule takes three numbers and an occurrence saves one);
#: a round takes pairs down to 1/FACTOR of the best.
LEAST, FACTOR = 8, 64
#: Units encoded in one call, and bytes of units a worker keeps.
TOGETHER, UNITS_BYTES = 512, 128 << 20
#: Bytes of texts encoded at once.
SLICE = 12_000_000
SCHEMA = "part int, shard int, doc_ids array<bigint>, counts array<int>, n_tokens bigint, rules array<int>, lengths array<int>, sequence array<int>"

#: White space by any library's reckoning but ASCII, and all of it with control characters.
_SPACES = "\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
_WIDE = rf"\x00-\x20{_SPACES}"
#: Texts that are cut in Python: those that hold other white space than single blanks and line breaks, or start or end with some.
ODD = rf"[\x00-\x09\x0b-\x1f{_SPACES}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z"
#: The library's first step never joins what no white space is to the white space after it.
_cut = re.compile(rf"(?<=[^{_WIDE}])(?=[ \t\n\r])")


#: Nor what is a letter or digit to these marks, so that a word with and without them is one unit.
APART = ("([A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([.,;:!?]+)([ \n]|\\z)", f"\\1 {LITERAL}\\2\\3")


def units_of(text: str) -> list[str]:
    """The units of an odd text as keys of words.py: white space and the word after it."""
    return [LITERAL + u for u in _cut.split(text)] if text else []


def store(path: str, end_id: int) -> Store:
    """One tokenizer and store a worker process."""
    return worker_state(("tokenizer", path, end_id), lambda: new_store(path, end_id))


def new_store(path: str, end_id: int) -> Store:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = {i: len(t.content.encode()) for i, t in tokenizer.get_added_tokens_decoder().items()}
    size = np.array([added.get(i, len(tokenizer.id_to_token(i) or "")) for i in range(tokenizer.get_vocab_size())], np.int64)

    def apart(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter((i for x in found for i in x), np.int32), np.array([len(x) for x in found], np.int64)

    def together(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Units one after another: white space starts each, so no id crosses from one to the next."""
        edges = [*range(0, len(texts), TOGETHER), len(texts)]
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), texts), "").to_pylist()
        found = [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        ends, upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), np.cumsum(size[ids])
        last = np.searchsorted(upto, ends)
        if len(ends) and (not len(upto) or last[-1] >= len(upto) or (upto[last] != ends).any()):  # another kind of tokenizer: its ids do not stand for so many bytes
            return apart(texts.to_pylist())
        return ids, np.diff(last, prepend=-1)

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys = pa.array(units, pa.string())
        plain = pc.invert(pc.or_(pc.starts_with(keys, LITERAL), pc.equal(keys, "")))
        texts = keys.filter(plain)
        blank = pc.if_else(pc.starts_with(texts, "\n"), "", " ")
        rest = [unit_text(u) for u in keys.filter(pc.invert(plain)).to_pylist()]
        parts = [together(pc.binary_join_element_wise(blank, texts, "")), apart(rest)]
        flat, counts = np.concatenate([f for f, _ in parts]), np.concatenate([c for _, c in parts])
        if not rest:
            return flat, counts
        own = plain.to_numpy(zero_copy_only=False)
        order = np.empty(len(units), np.int64)
        order[np.concatenate([np.flatnonzero(own), np.flatnonzero(~own)])] = np.arange(len(units))
        return gathered_ids(flat, (np.cumsum(counts) - counts)[order], counts[order]), counts[order]

    kind = str(tokenizer.pre_tokenizer)
    words = Store(encode, end_id, UNITS_BYTES)
    words.cuts_words = kind.startswith("ByteLevel(") and "use_regex=True" in kind and tokenizer.normalizer is None
    return words


def encoded_texts(texts: pa.Array, path: str, end_id: int) -> pa.Array:
    """The ids of each whole text and the end id."""
    words = store(path, end_id)
    if not words.cuts_words:  # a tokenizer whose first step is another: whole texts
        return encoded(texts, words, r"\A", lambda t: [LITERAL + t] if t else [], size=SLICE)
    return encoded(texts, words, ODD, units_of, LITERAL, APART, SLICE)


def counted(pairs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs, which of them each place holds, how often each is there) of pairs of so many bits."""
    more = len(pairs).bit_length()
    if bits + more < 64:  # pair and place in one number sort faster than places by their pairs
        order = pairs << more
        order |= np.arange(len(pairs))
        order.sort()
        pairs = order >> more
        order &= (1 << more) - 1
    else:
        order = np.argsort(pairs)
        pairs = pairs[order]
    fresh = np.append(True, pairs[1:] != pairs[:-1])
    starts = np.flatnonzero(fresh)
    own = np.empty(len(pairs), np.int32)
    own[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return pairs[starts], own, np.diff(starts, append=len(pairs))


def compressed(seq: np.ndarray, end_id: int, least: int = LEAST, factor: int = FACTOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, their expansion lengths, what is left of seq).  No pair starts with the end id.

    A pair that is rare once never becomes frequent, as replacements only make pairs of new symbols; so a
    round looks at the places that were frequent in the last one and at those beside its replacements.
    Symbols stay where they start: one that stands for w ids is followed by what starts w places on.
    """
    sides: list[np.ndarray] = []
    lengths: list[np.ndarray] = [np.zeros(0, np.int64)]
    n, made = len(seq), 0
    seq = seq.astype(np.int32)
    wide = np.ones(n, np.int32)
    begins = np.arange(n, dtype=np.int32)  # by a symbol's last place, its first
    live = np.ones(n, bool)
    look = seq != end_id
    look[-1:] = False
    while (at := np.flatnonzero(look)).size:
        bits = (RULE_BASE + made).bit_length()
        pairs = seq[at].astype(np.int64)
        pairs <<= bits
        pairs |= seq[at + wide[at]] if made else seq[1:][at]
        keys, own, counts = counted(pairs, 2 * bits)
        often = (counts >= least)[own]
        at, own = at[often], own[often]
        look[:] = False
        look[at] = True
        if not len(at):
            break
        near = (counts >= -(-int(counts.max()) // factor))[own]
        at, own = at[near], own[near]
        # A pair stands if neither overlapping pair is stronger; in a run of one pair every other one.
        power = (counts << 32 | np.arange(len(keys)))[own]
        follows = at[1:] == (at + wide[at])[:-1]
        beaten = np.append(False, follows & (power[:-1] > power[1:])) | np.append(follows & (power[1:] > power[:-1]), False)
        at, own = at[~beaten], own[~beaten]
        first = np.append(True, at[1:] != (at + wide[at])[:-1])
        stands = (np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]) % 2 == 0
        at, own = at[stands], own[stands]
        # What overlapping pairs leave to a pair may not pay for its rule; the strongest pair keeps at least half.
        pays = np.bincount(own, minlength=len(keys)) * 2 >= least
        at, own = at[pays[own]], own[pays[own]]
        new = np.stack([keys[pays] >> bits, keys[pays] & (1 << bits) - 1], axis=1)
        which = (np.cumsum(pays) - 1)[own]
        gone = at + wide[at]
        live[gone] = look[gone] = False
        wide[at] += wide[gone]
        after = at + wide[at]
        begins[after - 1] = at
        seq[at] = RULE_BASE + made + which
        size = np.zeros(len(new), np.int64)
        size[which] = wide[at]
        lengths.append(size)
        made += len(new)
        sides.append(new)
        look[at] = after < n
        before = begins[at[at > 0] - 1]
        look[before] = seq[before] != end_id
    rules = np.concatenate(sides) if sides else np.zeros((0, 2))
    return rules.astype(np.int32), np.concatenate(lengths), seq[live]


def opened(seq: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that seq stands for: all rules of a round's depth are opened together."""
    while len(seq) and (own := seq >= RULE_BASE).any():
        times = 1 + own
        at = np.cumsum(times) - times
        out = np.repeat(seq, times)
        pair = rules[seq[own] - RULE_BASE]
        out[at[own]], out[at[own] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def expanded(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that seq stands for: every rule is opened once, and seq is one gather from what they give."""
    own = seq >= RULE_BASE
    flat = np.concatenate([opened(np.arange(len(rules), dtype=np.int32) + RULE_BASE, rules), seq[~own]])
    n = np.ones(len(seq), np.int64)
    start = np.cumsum(~own) - 1 + int(lengths.sum())
    rule = seq[own] - RULE_BASE
    n[own], start[own] = lengths[rule], (np.cumsum(lengths) - lengths)[rule]
    return gathered_ids(flat, start, n)


def document_ids(row: dict, k: int) -> np.ndarray:
    """Random access: the ids of the k-th document of a shard, without expanding the others."""
    seq, rules, lengths = (np.asarray(row[c], np.int64) for c in ("sequence", "rules", "lengths"))
    counts = np.asarray(row["counts"], np.int64)
    start, end = int(counts[:k].sum()), int(counts[: k + 1].sum())
    size = np.ones(len(seq), np.int64)
    rule = seq >= RULE_BASE
    size[rule] = lengths[seq[rule] - RULE_BASE]
    upto = np.cumsum(size)
    a, b = np.searchsorted(upto, start, "right"), np.searchsorted(upto, end, "left")
    skip = start - int(upto[a] - size[a])
    return opened(seq[a:b + 1], rules.reshape(-1, 2))[skip:skip + end - start]


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about so many bytes out of smaller ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def write_ids(df: DataFrame, out: str, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode df's whole texts and write the shards, ascending by doc_id over parts and shards.

    One shuffle: rows are dealt out by ranges of (doc_id, hash of the text).
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        docs: list = []
        held = 0

        def row() -> pa.RecordBatch:
            nonlocal shard, held
            flat, n = np.concatenate(ids), np.concatenate(counts)
            rules, lengths, seq = compressed(flat, end_id)
            arrays = [
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([docs], pa.list_(pa.int64())), list_array(n, np.array([len(n)])), pa.array([len(flat)], pa.int64()),
                *(list_array(x.reshape(-1), np.array([x.size])) for x in (rules, lengths, seq)),
            ]
            shard, held = shard + 1, 0
            ids.clear()
            counts.clear()
            docs.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in gathered(batches, SLICE):
            names = batch.column(0).to_pylist()
            own = encoded_texts(batch.column(1), path, end_id)
            flat, upto = own.values.to_numpy(), own.offsets.to_numpy()
            at = 0
            while at < len(names):  # a shard is closed by the document that fills it
                to = min(int(np.searchsorted(upto, upto[at] + shard_tokens - held)), len(names))
                ids.append(flat[upto[at]:upto[to]])
                counts.append(np.diff(upto[at:to + 1]))
                docs += names[at:to]
                held += int(upto[to] - upto[at])
                at = to
                if held >= shard_tokens:
                    yield row()
        if docs:
            yield row()

    ordered = (
        small_batches(df).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
        .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    )
    ordered.mapInArrow(shards, SCHEMA).write.parquet(out)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids (if asked for).

    Starts come from running sums at three levels: parts, the shards of a part, the documents of a
    shard; only per-part sums meet in one task.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    sizes = stored.select("part", "shard", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    own = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    starts = shards.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))

    schema = "part int, shard int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, shard, docs, counts, rules, lengths, seq = (batch.column(c)[k] for c in ("part", "shard", "doc_ids", "counts", "rules", "lengths", "sequence"))
                n = counts.values.to_numpy()
                flat = expanded(seq.values.to_numpy(), rules.values.to_numpy().reshape(-1, 2), lengths.values.to_numpy().astype(np.int64)).astype("<u4")
                ends = np.cumsum(n, dtype=np.int64)
                crc = [zlib.crc32(flat[e - c:e]) for e, c in zip(ends.tolist(), n.tolist(), strict=True)]
                arrays = [
                    pa.array(np.full(len(n), part.as_py(), np.int32)), pa.array(np.full(len(n), shard.as_py(), np.int32)),
                    docs.values, pa.array(ends - n), pa.array(n.astype(np.int64)), pa.array(crc, pa.int64()), *([list_array(flat, n)] if with_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

    rows = stored.select("part", "shard", "doc_ids", "counts", "rules", "lengths", "sequence").mapInArrow(decoded, schema)
    starts = broadcast_if_small(saved(starts), F.lit(16))
    return rows.join(starts, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
