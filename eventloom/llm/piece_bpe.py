"""SentencePiece BPE by vectorised merge rounds.

The symbols of all new words of a batch lie in one flat numpy array.  A round finds, for each word,
the least rank among its adjacent pairs (a segmented minimum), merges at once every leftmost,
non-overlapping pair of that rank, and compacts the array; words without a pair leave.  The library
merges one pair at a time; the outcome is the same unless a merge makes a pair of no greater rank,
and where that would happen the word merges only its first pair in that round.

The library's model file gives the pieces and scores; its encoder is not used.

Defined results: a null or empty text has only the end id, and decodes to the empty text; repeated
rows are encoded each; texts are encoded whole; an empty table gives an empty result; other columns
are not touched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import released, small_batches, worker_state
from .words import LITERAL, Store, encoded, unit_text

SPACE = "▁"
#: Ids decoded at once within an Arrow batch.
SLICE_IDS = 1_000_000
_far = np.iinfo(np.int32).max
_UNITS = re.compile(r" *[^ \n]+| +|\n")
#: Texts that need it: empty ones, blanks in a row or in front, the marks of units.
ODD = r"\A\z|  |\A[ \n]|[\x01\x02]"


def units_of(text: str) -> list[str]:
    """The units of an odd text as keys of words.py: a run of blanks, a line break, a word with the blanks before it."""
    marked = (" ", "\x01", "\x02", "\n", "")
    return [u[1:] if u[0] == " " and u[1:2] not in marked else LITERAL + u for u in _UNITS.findall(" " + text)] if text else []


class Model:
    """Pieces, pair ranks and byte ids of a BPE model file with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) or ("\n" in pieces[i] and len(pieces[i]) > 1) for i in plain):
            raise ValueError("a piece crosses words: this model needs whole texts as units")
        self.end_id = sp.eos_id()
        self.surface = [b"" if sp.is_control(i) else pieces[i].replace(SPACE, " ").encode() for i in range(n)]
        self.bytes = np.zeros(256, np.int32)
        self.byte_ids = {}
        for i in range(n):
            if sp.is_byte(i):
                b = int(pieces[i][3:5], 16)
                self.bytes[b], self.byte_ids[i], self.surface[i] = i, b, bytes([b])
        if sp.unk_id() >= 0:
            self.surface[sp.unk_id()] = " ⁇ ".encode()
        ids = {pieces[i]: i for i in plain}
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        # Characters that only longer pieces have are symbols too, with ids beyond the vocabulary.
        chars = dict.fromkeys(c for i in plain for c in pieces[i])
        self.symbols = ids | {c: n + k for k, c in enumerate(x for x in chars if x not in ids)}
        self.n, self.spare = n, n + len(self.symbols)
        self.by_code = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.by_code[ord(c)] = self.symbols[c]
        found = {}
        for i in plain:
            p = pieces[i]
            for cut in range(1, len(p)):
                a, b = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if a is not None and b is not None:
                    found[a << 32 | b] = (i, ranks[sp.get_score(i)])
        keys = np.array(sorted(found), np.int64)
        self.made = np.array([found[k][0] for k in keys.tolist()] + [0], np.int32)
        self.rank = np.array([found[k][1] for k in keys.tolist()] + [_far], np.int32)
        # Pairs by hash: at most a few keys share a slot, so a lookup is a few gathers.
        self.mask = (1 << 20) - 1
        slot = self.hashed(keys)
        order = np.argsort(slot, kind="stable")
        place = np.arange(len(keys)) - np.searchsorted(slot[order], slot[order])
        self.depth = int(place.max()) + 1
        self.keys = np.append(keys, -1)
        self.slots = np.full((self.depth, self.mask + 1), len(keys), np.int32)
        self.slots[place, slot[order]] = order

    def hashed(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(44)).astype(np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of each pair into made and rank; the last index for no pair."""
        keys = a.astype(np.int64) << 32 | b
        slot, none = self.hashed(keys), len(self.keys) - 1
        out = np.full(len(keys), none, np.int32)
        for level in self.slots:
            at = level[slot]
            out = np.where(self.keys[at] == keys, at, out)
        return out

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct units and the ids of each."""
        texts = [unit_text(u).replace(" ", SPACE) for u in units]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        sym = self.by_code[codes]
        # A character that no piece has is its own symbol, told by its code.
        sym = np.where(sym < 0, self.spare + codes, sym)
        sym, word = self.merged(sym, word)
        return self.final(sym, word, len(texts))

    def merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done_sym, done_word = [], []

        def ranked(s, w, i):
            pair = np.full(len(i), len(self.keys) - 1, np.int32)
            inside = i + 1 < len(s)
            j = i[inside]
            pair[inside] = np.where(w[j] == w[j + 1], self.pairs(s[j], s[j + 1]), len(self.keys) - 1)
            return pair

        pair = ranked(sym, word, np.arange(len(sym)))
        while len(sym):
            rank = self.rank[pair]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            length = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), length)
            live = least < _far
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, pair, rank, least = sym[live], word[live], pair[live], rank[live], least[live]
                if not len(sym):
                    break
            at = rank == least
            # Of runs of overlapping pairs every other one, from the left.
            i = np.flatnonzero(at)
            run = np.cumsum(np.diff(i, prepend=-9) > 1)
            place = np.arange(len(i)) - np.searchsorted(run, run)
            i = i[place % 2 == 0]
            while True:
                new = sym.copy()
                new[i] = self.made[pair[i]]
                keep = np.ones(len(sym), bool)
                keep[i + 1] = False
                s, w, p = new[keep], word[keep], pair[keep]
                to = (np.cumsum(keep) - 1)[i]
                touched = np.unique(np.concatenate([to, to[to > 0] - 1]))
                p[touched] = ranked(s, w, touched)
                # A new pair of no greater rank comes before the other pairs of this round.
                early = np.unique(w[touched][self.rank[p[touched]] <= least[keep][touched]])
                if not len(early):
                    break
                mine = word[i]
                bad = np.isin(mine, early) & (np.diff(mine, prepend=-1) == 0)
                if not bad.any():
                    break
                i = i[~bad]
            sym, word, pair = s, w, p
        if not done_sym:
            return sym, word
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def final(self, sym: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary become the ids of their bytes."""
        odd = sym >= self.n
        if odd.any():
            own = {v: k for k, v in self.symbols.items() if v >= self.n}
            raw = [own.get(x, None) or chr(x - self.spare) for x in sym[odd].tolist()]
            raw = [x.encode("utf-8", "surrogatepass") for x in raw]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(x) for x in raw]
            ids, word = np.repeat(sym, times), np.repeat(word, times)
            ids[np.repeat(odd, times)] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
            sym = ids
        return sym.astype(np.int32), np.bincount(word, minlength=n)

    def decode(self, lists: pa.ListArray) -> list[str]:
        table = pa.array(self.surface, pa.binary())
        lists = lists.fill_null([]) if lists.null_count else lists
        flat = pc.list_flatten(lists)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), table.take(flat)), b"")
        out, at = [], 0
        for raw, k in zip(joined.to_pylist(), counts.tolist(), strict=True):
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = self.decode_bytewise(flat[at:at + k].to_pylist())
            out.append(text[1:] if text[:1] == " " and self.leads(flat, at, k) else text)
            at += k
        return out

    def leads(self, flat: pa.Array, at: int, k: int) -> bool:
        """Whether the first surface is a piece: the library drops the blank it starts with."""
        for i in range(at, at + k):
            x = flat[i].as_py()
            if self.surface[x]:
                return x not in self.byte_ids and self.surface[x] != " ⁇ ".encode()
        return False

    def decode_bytewise(self, ids: list[int]) -> str:
        """Bytes that are no character become one replacement character each."""
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                at += n
            run.clear()

        for i in ids:
            if i in self.byte_ids:
                run.append(self.byte_ids[i])
            else:
                flush()
                out.append(self.surface[i].decode())
        flush()
        return "".join(out)


def state(path: str) -> tuple[Model, Store]:
    """One model and store a worker process."""
    def new() -> tuple[Model, Store]:
        own = Model(path)
        return own, Store(own.encode, own.end_id)

    return worker_state(("pieces", path), new)


def model(path: str) -> Model:
    return state(path)[0]


def store(path: str) -> Store:
    return state(path)[1]


def encoded_texts(texts: pa.Array, path: str) -> pa.Array:
    """The piece ids of each whole text and the end id."""
    return encoded(pc.replace_substring(texts, SPACE, " "), store(path), ODD, units_of)


def runs_of(lists: pa.ListArray, ids: int = SLICE_IDS) -> list[pa.Array]:
    """The batch's lists in runs of about so many ids."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    edges = [0, *(np.flatnonzero(np.diff(upto // ids)) + 1).tolist(), len(lists)]
    return [lists.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def with_pieces(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with ids: the piece ids of the whole text and the end id."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        return released(encoded_texts(texts, path))

    return small_batches(df).withColumn(ids, encode(F.coalesce(F.col(text), F.lit(""))))


def with_text(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with text: the ids decoded; null ids decode to the empty text."""

    @F.arrow_udf(T.StringType())
    def decode(lists: pa.Array) -> pa.Array:
        return released(pa.concat_arrays([pa.array(model(path).decode(run), pa.string()) for run in runs_of(lists)]))

    return small_batches(df).withColumn(text, decode(F.col(ids)))
