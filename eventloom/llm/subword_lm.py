"""LM scoring by subword lattice likelihood.

A word is spelled by the pieces of an installed vocabulary in many ways; its probability is the sum over
all of them, taken by a forward recursion in log space over the lattice of pieces.  Pieces start from the
vocabulary's own scores and are fitted to the corpus by expectation maximisation: every round runs
forward and backward over the table of distinct training words, which grows with the corpus, and sums the
pieces' posterior counts.  Words seen in training are entries of the lattice too, an arc over the whole
word; what mass is left to spelling is the share of once-seen words (Good and Turing's estimate of the
mass not seen).  A document is its words, then one end, so its log probability is the sum over its words.

Words are the bytes between ASCII white space, A-Z lower-cased.  Counting is one pre-aggregated shuffle
of distinct words.  A document's frequent words (each one in HOT or more of all words, so HOT at most)
are looked up in a broadcast of proven size; the others go to the word table by a shuffle, and as none
of them is frequent no task meets a hot key.

Defined results: a null or empty text is one end; a null id is learned from; texts are read whole, in
slices, however long; repeated rows count each; equal texts have equal scores; with no training row every
word is spelled with the vocabulary's own scores; an empty table gives an empty result.  Only the named
columns are read, so clashing names do no harm.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import released, saved, small_batches, worker_state

#: Rounds of expectation maximisation, and the count every piece has before any is seen.
ROUNDS, PRIOR = 3, 0.1
#: Words that are one in HOT or more of all words are looked up in a broadcast, if they have so few bytes.
HOT, HOT_BYTES = 1 << 16, 256
#: Bytes of texts counted at once, words gathered for their lattices, cells of the lattices built at once, rows sent at once.
SLICE_BYTES, GATHERED_WORDS, LATTICE_CELLS, SENT_ROWS = 1 << 20, 20_000, 500_000, 50_000
#: Bytes of texts whose words are counted together.
COUNTED_BYTES = 4 << 20
#: The mark that begins a word in the vocabulary.
START = "▁"

_space = re.compile(rb"[\x20\x09-\x0d]")


def held_out(doc_id: str) -> Column:
    """Rows never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(7)) == 2, F.lit(False))


def word_counts(raw: bytes | None) -> Counter:
    """How often each word stands in a text; a slice of it at a time."""
    raw, found, a = raw or b"", Counter(), 0
    while a < len(raw):
        cut = _space.search(raw, a + SLICE_BYTES) if a + SLICE_BYTES < len(raw) else None
        b = cut.start() if cut else len(raw)
        found.update(raw[a:b].lower().split())
        a = b
    return found


class Pieces:
    """The pieces of a vocabulary by length, to be found in many words at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        usable = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        scores = np.array([model.get_score(i) for i in range(self.size)])
        if scores[usable].min() < -100 and np.all(scores == np.round(scores)):  # ranks, as merges have them: Zipf's law
            ranks = np.where(scores > -self.size, -scores, self.size)
            ranks[self.byte] = self.size
            weights = 1 / (10 + ranks)
        else:
            weights = np.exp(scores)
            weights[self.byte] = weights[usable].min()
        self.used = np.zeros(self.size, bool)
        self.used[usable] = self.used[self.byte] = True
        weights[~self.used] = 0
        self.start = logs(weights / weights.sum())
        by: dict[int, list[int]] = {}
        for i in usable:
            by.setdefault(len(model.id_to_piece(i)), []).append(i)
        self.longest = max(by)
        #: length -> (marks of the hashes' upper bits, hashes in order, ids, characters) of the pieces of that length
        self.known = {}
        for n, ids in by.items():
            chars = np.array([[ord(c) for c in model.id_to_piece(i)] for i in ids], np.uint64)
            h = np.zeros(len(ids), np.uint64)
            for k in range(n):
                h = h * MULTIPLIER + chars[:, k]
            order = np.argsort(h, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[(h >> SHIFT).astype(np.int32)] = True
            self.known[n] = (maybe, h[order], np.array(ids)[order], chars[order])


MULTIPLIER, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)


def logs(p: np.ndarray) -> np.ndarray:
    return np.log(p, where=p > 0, out=np.full(len(p), -np.inf))


class Lattice:
    """The lattices of words of one length (their mark included), as dense arrays.

    arc[word, end - 1, l - 1] is the piece of l characters that ends before place end, or -1; a character
    without a piece of its own is spelled by its bytes.
    """

    def __init__(self, chars: np.ndarray, pieces: Pieces):
        words, self.size = chars.shape
        self.pieces, self.wide = pieces, min(pieces.longest, self.size)
        self.arc = np.full((words, self.size, self.wide), -1, np.int32)
        h = np.zeros((words, self.size + 1), np.uint64)
        for n in range(1, self.wide + 1):
            h = h[:, :-1] * MULTIPLIER + chars[:, n - 1:]  # of the n characters from each place on
            if n not in pieces.known:
                continue
            maybe, hashes, ids, spelled = pieces.known[n]
            word, first = np.nonzero(maybe[(h >> SHIFT).astype(np.int32)])
            at = np.minimum(np.searchsorted(hashes, h[word, first]), len(hashes) - 1)
            same = (chars[word[:, None], first[:, None] + np.arange(n)] == spelled[at]).all(axis=1)
            self.arc[word[same], first[same] + n - 1, n - 1] = ids[at[same]]
        self.alone = np.nonzero(self.arc[:, :, 0] < 0)
        spelled = [chr(int(c)).encode("utf-8", "replace") for c in chars[self.alone]]
        self.bytes_of = np.repeat(np.arange(len(spelled)), [len(b) for b in spelled])
        self.byte_piece = pieces.byte[np.frombuffer(b"".join(spelled), np.uint8)] if spelled else np.zeros(0, np.int64)

    def weigh(self, log_p: np.ndarray) -> None:
        self.log = np.where(self.arc >= 0, log_p[self.arc], -np.inf)
        self.log[(*self.alone, np.zeros(len(self.alone[0]), int))] = np.bincount(self.bytes_of, log_p[self.byte_piece], len(self.alone[0]))

    def likelihood(self) -> np.ndarray:
        """The log probability of every word, all its spellings together: log sums forward over all paths from the start."""
        self.ahead = np.zeros((len(self.arc), self.size + 1))
        for end in range(1, self.size + 1):
            n = min(end, self.wide)
            self.ahead[:, end] = log_sums(self.ahead[:, end - n:end][:, ::-1] + self.log[:, end - 1, :n])
        return self.ahead[:, -1]

    def expected(self, counts: np.ndarray) -> np.ndarray:
        """How often each piece is used, all spellings weighed, in so many occurrences of the words."""
        whole = self.likelihood()
        behind = np.zeros_like(self.ahead)
        for first in range(self.size - 1, -1, -1):
            n = min(self.size - first, self.wide)
            behind[:, first] = log_sums(behind[:, first + 1:first + n + 1] + self.log[:, np.arange(first, first + n), np.arange(n)])
        word, last, less = np.nonzero(self.arc >= 0)
        share = np.exp(self.ahead[word, last - less] + self.log[word, last, less] + behind[word, last + 1] - whole[word]) * counts[word]
        out = np.bincount(self.arc[word, last, less], share, self.pieces.size)
        word, last = self.alone
        share = np.exp(self.ahead[word, last] + self.log[word, last, 0] + behind[word, last + 1] - whole[word]) * counts[word]
        return out + np.bincount(self.byte_piece, share[self.bytes_of], self.pieces.size)


def log_sums(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    top[np.isneginf(top)] = 0
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def lattices(words: list[bytes], pieces: Pieces) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Places of words of one length and their lattices, a bounded number of cells at once (a longer word alone)."""
    text = [START + w.decode("utf-8", "replace") for w in words]
    sizes = np.array([len(t) for t in text], np.int64)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        size = int(sizes[order[a]])
        step = max(LATTICE_CELLS // (size * min(size, pieces.longest)), 1)
        for c in range(a, b, step):
            own = order[c:min(c + step, b)]
            flat = np.frombuffer("".join([text[i] for i in own]).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield own, Lattice(flat.reshape(len(own), size).astype(np.uint64), pieces)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of words put together to larger ones: of one length there are more words then."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + len(batch), size + batch.nbytes
        if rows >= GATHERED_WORDS or size >= SLICE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def counted_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(word, c, n): every word with its occurrences in training rows and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(texts: list[bytes], held: bool) -> pa.RecordBatch:
            own = word_counts(b"\n".join(texts))
            n = pa.array(own.values(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array([0] * len(own), pa.int64()) if held else n, n], names=["word", "c", "n"])

        waiting, sizes = {True: [], False: []}, {True: 0, False: 0}
        for batch in batches:
            for held, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = raw.as_py() or b""
                waiting[held].append(text)
                sizes[held] += len(text)
                if sizes[held] > COUNTED_BYTES:
                    yield sent(waiting[held], held)
                    waiting[held], sizes[held] = [], 0
        for held, texts in waiting.items():
            yield released(sent(texts, held))

    raw = small_batches(docs).select(held_out(doc_id).alias("held"), F.col(text).cast("binary").alias("raw"))
    return raw.mapInArrow(count, "word binary, c bigint, n bigint").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


class Model:
    """What was learned: words (saved: word, c, n, base, score), the sums over training tokens and the pieces' log probabilities."""

    def __init__(self, words: DataFrame, sums: dict, log_p: np.ndarray, end_base: float, end_score: float):
        self.words, self.sums, self.log_p, self.end_base, self.end_score = words, sums, log_p, end_base, end_score


def fitted_pieces(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """The pieces' log probabilities after so many rounds over the training words of a saved table (word, c, n).

    A word type counts once: spelling has to do with the words that were not seen.
    """
    pieces, session = Pieces(path), words.sparkSession
    log_p = pieces.start
    trained = words.where("c > 0").select("word")
    for _ in range(rounds):
        sent = session.sparkContext.broadcast(log_p)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = worker_state(("lattice", path), lambda: Pieces(path))
            total = np.zeros(own.size)
            for batch in gathered(batches):
                for at, part in lattices(batch.column(0).to_pylist(), own):
                    part.weigh(sent.value)
                    total += part.expected(np.ones(len(at)))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["piece", "uses"])

        uses = trained.mapInArrow(expect, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # one row a piece of the vocabulary at most
        sent.destroy()
        if not uses:
            break
        p = np.where(pieces.used, PRIOR, 0.0)
        for r in uses:
            p[r["piece"]] += r["uses"]
        log_p = logs(p / p.sum())
    return log_p


def fit(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> Model:
    """Learn from the rows that are not held out; the words of all rows get their scores."""
    session = docs.sparkSession
    words = saved(counted_words(docs, doc_id, text))
    ends = docs.where(~held_out(doc_id)).count()
    got = words.agg(*(F.coalesce(x, F.lit(0)).alias(k) for k, x in {"words": F.sum("c"), "types": F.sum((F.col("c") > 0).cast("long")), "once": F.sum((F.col("c") == 1).cast("long")), "all": F.sum("n")}.items())).first().asDict()
    sums = got | {"ends": ends, "tokens": got["words"] + ends, "distinct": got["types"] + (ends > 0)}
    log_p = fitted_pieces(words, path, rounds)
    sent = session.sparkContext.broadcast(log_p)
    spelled = (sums["once"] + 1) / (sums["words"] + 2) if sums["words"] else 1.0
    end = (ends + 1) / (sums["tokens"] + 2)
    total, seen, tens = sums["tokens"] + 1 * (sums["distinct"] + 1), max(sums["words"], 1), np.log(10)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_state(("lattice", path), lambda: Pieces(path))
        for batch in gathered(batches):
            c = batch.column(1).to_numpy(zero_copy_only=False)
            log = np.zeros(len(c))
            for at, part in lattices(batch.column(0).to_pylist(), own):
                part.weigh(sent.value)
                log[at] = part.likelihood()
            log = np.logaddexp(np.log(spelled) + log, logs((1 - spelled) * c / seen))  # the arc over the whole word
            cols = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.log10((c + 1) / total)), pa.array((log + np.log1p(-end)) / tens)]
            yield released(pa.RecordBatch.from_arrays(cols, names=["word", "c", "n", "base", "score"]))

    done = saved(words.mapInArrow(score, "word binary, c bigint, n bigint, base double, score double"))
    return Model(done, sums, log_p, float(np.log10((ends + 1) / total)), float(np.log10(end)))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) of every row."""
    session, sums = docs.sparkSession, model.sums
    frequent = model.words.where((F.col("n") * HOT >= sums["all"]) & (F.length("word") <= HOT_BYTES))
    listed = [tuple(r) for r in frequent.select("word", (F.col("c") > 0).cast("int"), "base", "score").collect()]  # HOT words at most
    hot = session.sparkContext.broadcast(({bytes(r[0]): i for i, r in enumerate(listed)}, np.array([r[1:] for r in listed], float).reshape(-1, 3)))
    ended, end_base, end_score = int(sums["ends"] > 0), model.end_base, model.end_score
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "n"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (place, values), row = hot.value, TaskContext.get().partitionId() << 40
        known, kinds, heads, cold = place.get, None, [], [[], [], []]

        def sent() -> Iterator[pa.RecordBatch]:
            cols = [pa.array(c, k) for c, k in zip(list(zip(*heads, strict=True)) or [()] * 7, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(heads), pa.binary()), pa.nulls(len(heads), pa.int64())], names=names)
            rows, words, counts = cold
            if words:
                rows, counts = np.repeat(np.array([r for r, _ in rows]), [n for _, n in rows]), np.concatenate(counts)
                yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.nulls(len(words), k) for k in kinds[1:]), pa.array(words, pa.binary()), pa.array(counts)], names=names)

        for batch in batches:
            kinds = [pa.int64(), batch.column(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            for name, held, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = word_counts(raw.as_py())
                row += 1
                words, counts = list(own), np.fromiter(own.values(), np.int64, len(own))
                at = np.fromiter(map(known, words, repeat(-1)), np.int64, len(words))
                found = at >= 0
                seen, base, score = counts[found] @ values[at[found]]
                heads.append((row, name, held, int(counts.sum()) + 1, ended + int(seen), end_base + base, end_score + score))
                if not found.all():
                    rest = np.flatnonzero(~found)
                    cold[0].append((row, len(rest)))
                    cold[1] += [words[i] for i in rest]
                    cold[2].append(counts[rest])
                if len(heads) + len(cold[1]) > SENT_ROWS:
                    yield from sent()
                    heads, cold = [], [[], [], []]
        if heads:
            for part in sent():
                yield released(part)

    kind = docs.schema[doc_id].dataType.simpleString()
    parts = saved(
        small_batches(docs).select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("binary").alias("raw"))
        .mapInArrow(look, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, word binary, n bigint")
    )
    cold = parts.where("word IS NOT NULL").select("row", "word", "n").join(model.words.select("word", "c", "base", "score"), "word")
    none = F.lit(None)
    rest = cold.select(
        "row", none.cast(kind).alias("doc_id"), none.cast("boolean").alias("held_out"), none.cast("bigint").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * F.col("base")).alias("base"), (F.col("n") * F.col("score")).alias("score"),
    )
    return parts.where("word IS NULL").select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score").unionByName(rest).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).drop("row")
