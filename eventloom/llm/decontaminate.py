"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is split into k + 1 pieces: text within k edits of the item
holds at least one piece unchanged.  An automaton finds all pieces of a block of items in every
document; hits of one item on near diagonals make a window, and Myers' bit-parallel algorithm gives
the least edit distance in it.  Texts and items are compared as lower-case words.

The items are a stated query set: they are read in blocks of BLOCK_CHARS, one after another, and each
block passes over all documents, so what a task or the driver holds does not grow with the benchmark.

Defined results: a null or empty text matches nothing; an item without words is left out; an item
shorter than two pieces must occur exactly, as whole words; texts are searched whole, however long; of
occurrences with equally few edits the first is given; repeated documents match each; items of equal
words match each; an empty table on either side gives an empty result.  Only the named columns are
read, and without_leaks() keeps the others whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, fresh, saved, small_batches, worker_state

#: Least characters of a piece: the budget is one edit for each piece but the first.
PIECE_CHARS = 16
#: Characters of the items handled in one pass.
BLOCK_CHARS = 20_000_000

_word = re.compile(r"\w+")
SCHEMA = "doc_id bigint, item_id bigint, distance int, start int, end int"


def plain(text: str | None) -> str:
    return " ".join(_word.findall((text or "").lower()))


def budget(item: str) -> int:
    return max(len(item) // PIECE_CHARS - 1, 0)


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces that cover the item, as equal as can be."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of pattern in text within most edits; the first end of the best."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full  # a row of zeros above: an occurrence starts anywhere
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Block:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = items
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for offset, piece in pieces(text):
                where.setdefault(piece, []).append((i, offset))
        self.find = ahocorasick.Automaton()
        for piece, places in where.items():
            self.find.add_word(piece, (len(piece), places))
        self.find.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best occurrence of every item in text."""
        starts: dict[int, list[int]] = {}
        for end, (size, places) in self.find.iter(text):
            for i, offset in places:
                starts.setdefault(i, []).append(end + 1 - size - offset)
        out = []
        for i, found in starts.items():
            name, item = self.items[i]
            k, best = budget(item), None
            found.sort()
            if not k:  # the piece is the item: its first occurrence as whole words
                out += [(name, 0, a, a + len(item)) for a in found if self.whole(text, a, a + len(item))][:1]
                continue
            a = 0
            while a < len(found):
                b = a
                while b + 1 < len(found) and found[b + 1] - found[b] <= 2 * k:
                    b += 1
                low, high = max(found[a] - k, 0), found[b] + len(item) + k
                part = text[low:max(high, 0)]
                got = myers(item, part, k)
                if got and (best is None or got[0] < best[0]):
                    back = myers(item[::-1], part[:got[1]][::-1], got[0])
                    best = (got[0], low + got[1] - back[1], low + got[1])
                a = b + 1
            if best:
                out.append((name, *best))
        return out

    @staticmethod
    def whole(text: str, a: int, b: int) -> bool:
        return (a == 0 or text[a - 1] == " ") and (b == len(text) or text[b] == " ")


def matches(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, start, end.

    start and end count characters of the document's lower-case words joined by blanks.
    """
    spark = docs.sparkSession
    items = bench.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // block_chars + 1
    pairs = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def passed(block, name: str) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = worker_state(("block", name), lambda: Block(block.value))
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in own.matches(plain(t.as_py()))]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "distance", "start", "end"])

        return pairs.mapInArrow(search, SCHEMA)

    found = None
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        block = [(r["item_id"], words) for r in own.collect() if (words := plain(r["text"]))]
        if block:
            sent = spark.sparkContext.broadcast(block)
            part = passed(sent, uuid.uuid4().hex)
            if blocks > 1:  # written before the next block is read
                part = saved(part)
                sent.destroy()
            found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def without_leaks(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """docs without those in which an item was found.  Documents of one id go together; null ids stay.

    The ids found are saved and measured: within the broadcast limit the texts stay where they are.
    """
    (leak,) = fresh(docs, "el_leak")
    leaks = saved(matches(docs, bench, doc_id, text, **names).select(F.col("doc_id").alias(leak)).distinct())
    return docs.join(broadcast_if_small(leaks, F.lit(8)), F.col(doc_id) == F.col(leak), "left_anti")
