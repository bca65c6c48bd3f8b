"""Near-duplicates by BagMinHash.

A document is a bag of five-word shingles.  Its signature follows the bag's weighted Jaccard
similarity without bias: every shingle owns Poisson processes over its weight axis, one for each
octave [0,1), [1,2), [2,4), ...; a document of weight w sees whole octaves below w and, of the last
one, the points below w (weights are counts, so the axis is discretised at whole numbers).  Points
come in order of time and fall on signature components; a component keeps its earliest point; a
process stops once its time is past the document's latest component.

Bands of the signature give candidate buckets, the bags' overlap verifies every candidate pair, and
connected components of the verified links are the classes.  In a large bucket the most central member
is compared with all others first.  Where a bucket then still holds several components, members of
different ones are compared if they share a shingle that is rare enough: as bags are similar only if
they share most, they must share one of their rarest.  So a large group of near copies costs a star, a
passage that many texts share costs nothing, and no link between different texts of a bucket is lost.

Defined results: a null text is the empty text; texts of fewer than five words are one shingle of
all their words, texts without words none (they are a class only with equal texts); equal texts are
always one class; the class id is the least document id of the class (null only if all are null);
repeated rows are in one class; texts are read whole, however long; an empty table gives an empty
result.  Only the named columns are read, and one_of_each() keeps the others whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import broadcast_if_small, fresh, released, saved, small_batches, worker_state
from .words import list_array, slices

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
#: Buckets of up to so many members are compared in full.
SMALL = 9
WORDS_KEPT = 100_000

_word = re.compile(r"\w+")
_u64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _u64(30))) * _u64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u64(27))) * _u64(0x94D049BB133111EB)
    return x ^ (x >> _u64(31))


class _Hashes(dict):
    """Words' hashes, kept for words seen before."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_PLACE = mixed(np.arange(1, SHINGLE + 1, dtype=_u64) * _u64(0x9E3779B97F4A7C15)) | _u64(1)


def shingles(text: str) -> np.ndarray:
    """A hash for every five-word shingle of the whole text, repeats included."""
    words = _word.findall(text.lower())
    h = np.fromiter(map(worker_state(("hashes",), _Hashes).__getitem__, words), _u64, len(words))
    if not len(h):
        return h
    if len(h) < SHINGLE:
        return mixed(np.array([(h * _PLACE[: len(h)]).sum(dtype=_u64) + _u64(len(h))], _u64))
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, _u64)
    for j in range(SHINGLE):
        total += h[j:j + n] * _PLACE[j]
    return mixed(total)


def bag(text: str) -> np.ndarray:
    """The bag as a set of (shingle, number of its occurrence) hashes: overlaps of bags are overlaps of sets."""
    s = np.sort(shingles(text))
    nth = np.arange(len(s)) - np.searchsorted(s, s)
    return np.where(nth == 0, s, mixed(s + nth.astype(_u64) * _u64(0x9E3779B97F4A7C15))).view(np.int64)


def signatures(bags: list[np.ndarray], m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash values (times of the earliest points), one row per shingle multiset."""
    docs = len(bags)
    items = [np.unique(s, return_counts=True) for s in bags]
    sizes = [len(s) for s, _ in items]
    key = np.concatenate([s for s, _ in items]) if docs else np.zeros(0, _u64)
    weight = np.concatenate([c for _, c in items]) if docs else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(docs), sizes)
    # The processes of a shingle: octave 0 covers [0, 1), octave j covers [2^(j-1), 2^j).
    parts, j, own = [], 0, np.arange(len(key))
    while len(own):
        parts.append((own, j))
        own = own[weight[own] > (1 << j)]
        j += 1
    at = np.concatenate([o for o, _ in parts]) if parts else np.zeros(0, np.int64)
    octave = np.concatenate([np.full(len(o), k) for o, k in parts]) if parts else np.zeros(0, np.int64)
    low = np.where(octave > 0, 1 << np.maximum(octave - 1, 0), 0)
    width = np.maximum(low, 1)
    seed, limit, doc = mixed(key[at] + octave.astype(_u64) * _u64(0xD1342543DE82EF95)), weight[at], doc[at]
    time = np.zeros(len(at))
    best = np.full(docs * m, np.inf)
    k = 0
    while len(seed):
        k += 1
        a = mixed(seed + _u64(2 * k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        b = mixed(seed + _u64((2 * k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((a >> _u64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        component = ((b & _u64(0xFFFFFFFF)).astype(np.int64) * m) >> 32
        level = low + (((b >> _u64(32)).astype(np.int64) * width) >> 32)
        hit = level < limit
        np.minimum.at(best, (doc * m + component)[hit], time[hit])
        latest = best.reshape(docs, m).max(axis=1)
        going = time < latest[doc]
        seed, time, doc, limit, low, width = (x[going] for x in (seed, time, doc, limit, low, width))
    return best.reshape(docs, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key a band: equal keys share a bucket."""
    bits = sig.view(_u64).reshape(len(sig), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_u64) * _u64(0x9E3779B97F4A7C15), (len(sig), BANDS))
    for r in range(ROWS):
        keys = mixed(keys + bits[:, :, r])
    return keys.view(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _band_keys(texts: pa.Array) -> pa.Array:
    parts = []
    for run in slices(texts, 1_000_000):
        bags = [shingles(t) for t in run]
        full = [i for i, s in enumerate(bags) if len(s)]
        counts = np.zeros(len(run), np.int64)
        counts[full] = BANDS
        flat = band_keys(signatures([bags[i] for i in full])).reshape(-1) if full else np.zeros(0, np.int64)
        parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat)))
    return released(pa.concat_arrays(parts))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _bag(texts: pa.Array) -> pa.Array:
    parts = []
    for run in slices(texts, 1_000_000):
        bags = [bag(t) for t in run]
        flat = np.concatenate([np.zeros(0, np.int64), *bags])
        parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(b) for b in bags])).astype(np.int32)), pa.array(flat)))
    return released(pa.concat_arrays(parts))


def node_of(text: str) -> Column:
    """Equal texts are one node of the graph.  (64 bits: among 10^9 texts a false meeting has odds of 3 %.)"""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def is_star_forest(edges: DataFrame) -> bool:
    """Whether every child has one root and no root is a child."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child + root > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, comp): each linked node's least node of its component, by alternating large and small stars.

    Every round is two joins with per-node minima; no node's neighbours are ever gathered, and rounds
    are saved to the shared folder.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = saved(large.join(lower, "u").select(F.inline(ends)).where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def least_shared(x: Column, y: Column, similarity: float) -> Column:
    """What two bags of these sizes must share to be similar: the multiset intersection over the union."""
    return F.ceil((x + y) * (similarity / (1 + similarity)) - 1e-6)


def verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose bags overlap by at least similarity."""
    a = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    b = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    x, y = F.size("bag_a"), F.size("bag_b")
    close = pairs.join(b, "b").join(a, "a").where(F.least(x, y) >= F.greatest(x, y) * similarity - 1e-6)
    return close.where(F.size(F.array_intersect("bag_a", "bag_b")) >= least_shared(x, y, similarity)).select("a", "b")


def open_nodes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) of the buckets' members, for the buckets that hold several components of links, saved.

    A component counts once in a bucket, so no bucket's members are gathered.
    """
    comps = components(links)
    placed = saved(members.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp")))
    ends = placed.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most")
    return saved(placed.join(ends.select("key"), "key", "left_semi").select("node", "comp").distinct())


def size_step(size: Column) -> Column:
    """Sizes in steps of 5 %, so that those of a range are a few equal keys."""
    return F.floor(F.log(F.greatest(size, F.lit(1.0))) / F.log(F.lit(1.05))).cast("int")


def rare_first(nodes: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """(node, comp, size, at, el): each bag's rarest elements with their places, those that no other bag has left out.

    Bags that share all they must share have one of these elements in common: beside the places up to
    size - shared + 1 there is not room for it all.
    """
    each = nodes.join(bags, "node").select("node", "comp", F.size("bag").alias("size"), F.explode("bag").alias("el"))
    often = each.groupBy("el").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = each.join(often, "el").groupBy("node", "comp", "size").agg(F.sort_array(F.collect_list(F.struct("n", "el"))).alias("own"))
    alone, room = F.col("size") - F.size("own"), F.col("size") - F.ceil(F.col("size") * similarity - 1e-6) + 1
    first = F.slice("own", F.lit(1), F.greatest(room - alone, F.lit(0)).cast("int"))
    return own.select("node", "comp", "size", alone.alias("alone"), F.posexplode(first).alias("i", "e")).select("node", "comp", "size", (F.col("alone") + F.col("i") + 1).alias("at"), F.col("e.el").alias("el"))


def pairs_by_rare(nodes: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components that may be similar: those with a rare element in common.

    The element must stand far enough in front in both bags to leave room for what they must share.  The
    larger bag of a pair meets the smaller one by the element and the step of the smaller one's size.
    """
    rare = saved(rare_first(nodes, bags, similarity))
    x, y, need = F.col("x"), F.col("y"), least_shared(F.col("x"), F.col("y"), similarity)
    most = F.least(F.col("size"), (F.col("size") + 1 - F.col("at")) * ((1 + similarity) / similarity) - F.col("size") + 1e-6)
    least = F.col("size") * similarity - 1e-6
    large = rare.where(least <= most).select("el", F.col("node").alias("b"), F.col("comp").alias("comp_b"), F.col("size").alias("x"), F.col("at").alias("at_x"), F.explode(F.sequence(size_step(least), size_step(most))).alias("step"))
    small = rare.where(F.col("at") <= F.col("size") - least_shared(F.col("size"), F.col("size"), similarity) + 1)
    small = small.select("el", F.col("node").alias("a"), F.col("comp").alias("comp_a"), F.col("size").alias("y"), F.col("at").alias("at_y"), size_step(F.col("size")).alias("step"))
    may = (F.col("comp_a") != F.col("comp_b")) & ((y < x) | ((y == x) & (F.col("a") < F.col("b")))) & (y >= x * similarity - 1e-6) & (F.col("at_x") <= x - need + 1) & (F.col("at_y") <= y - need + 1)
    return large.join(small, ["el", "step"]).where(may).select("a", "b").distinct()


def links_of(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """Verified links (a, b) between nodes, enough to connect every class.

    Buckets of up to SMALL members are compared in full.  In a larger one the member that has most
    company in all its buckets is the hub, compared with the rest.  Where that leaves a bucket with more
    than one component, its members are compared with those of other components with which they share a
    rare shingle, as all similar ones do.
    """
    raw = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("node", node_of("text"))
    rows = saved(raw.select("node", F.explode(_band_keys("text")).alias("key")).distinct())
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = saved(rows.join(shared, "key").select("key", "node", "n"))

    chosen = raw.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(members.select("node").distinct(), "node", "left_semi")
    chosen = broadcast_if_small(saved(chosen), F.lit(16))
    same = raw["doc_id"].eqNullSafe(chosen["doc_id"]) & (raw["node"] == chosen["node"])
    bags = saved(raw.join(chosen, same, "left_semi").select("node", _bag("text").alias("bag")))

    few, many = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    one, two = few.select("key", F.col("node").alias("a")), few.select("key", F.col("node").alias("b"))
    tried = one.join(two, "key").where("a < b").select("a", "b")

    company = many.groupBy("node").agg(F.sum("n").alias("company"))
    many = saved(many.select("key", "node").join(company, "node"))
    hubs = many.groupBy("key").agg(F.max_by("node", F.struct("company", "node")).alias("hub"))
    spokes = many.join(hubs, "key").where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    links = saved(verified(tried.unionByName(spokes).distinct(), bags, similarity))
    return saved(links.unionByName(verified(pairs_by_rare(open_nodes(many.select("key", "node"), links), bags, similarity), bags, similarity)))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, node (its text), comp (the class's node), class_id, class_size."""
    comps = saved(components(links_of(docs, doc_id, text, similarity)))
    placed = docs.select(F.col(doc_id).alias("doc_id"), node_of(text).alias("node")).join(comps, "node", "left")
    placed = saved(placed.select("doc_id", "node", F.coalesce("comp", "node").alias("comp")))
    ids = placed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(ids, "comp").select("doc_id", "node", "comp", "class_id", "class_size")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class: that of the class id (of equal ids the least text hash; of equal rows one)."""
    key, first_id, first_node = fresh(docs, "el_key", "el_id", "el_node")
    found = classes(docs, doc_id, text, similarity)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("comp").agg(F.first("class_id").alias(first_id), F.min("node").alias(first_node), F.count(F.lit(1)).alias("n"))
    first = saved(first.drop("comp"))
    more = not first.where("n > 1").isEmpty()
    chosen = broadcast_if_small(first.drop("n"), F.lit(24))
    kept = docs.withColumn(key, node_of(text)).join(chosen, F.col(doc_id).eqNullSafe(F.col(first_id)) & (F.col(key) == F.col(first_node)))
    if more:  # equal ids: rows of one id and one text are alike but for other columns
        kept = kept.dropDuplicates([first_id, first_node])
    return kept.drop(key, first_id, first_node)
