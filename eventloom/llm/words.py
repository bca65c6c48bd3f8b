"""Texts as units that no token crosses, and a store of the units' token ids that is bounded by bytes.

A unit is a word with its leading space, or a word with its leading line break.  Arrow splits a batch
into units and finds the distinct ones; only those reach Python, and of them only those that the store
does not know reach the encoder.  A text's ids are then a gather from flat numpy arrays.

Texts whose white space is not that regular are odd: the caller says how to cut them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of units and ids that a worker keeps, and what a unit costs beside its characters and ids.
STORE_BYTES, UNIT_BYTES = 40 << 20, 200
#: Longer units are encoded and not kept.
LONGEST_KEPT = 64
#: Texts handled at once within an Arrow batch, and units encoded at once.
SLICE_CHARS, NEW_UNITS = 4_000_000, 20_000
#: Marks: of a literal unit (a key without it has a blank before it, unless it starts with a line break), and of a text's end.
LITERAL, END = "\x01", "\x02end"


def unit_text(key: str) -> str:
    return key[1:] if key[:1] == LITERAL else key if key[:1] == "\n" else " " + key


def gathered_ids(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at starts and hold so many ids, one after another."""
    kind = np.int32 if max(len(flat), int(counts.sum())) < 1 << 30 else np.int64
    ends = np.cumsum(counts, dtype=kind)
    first = starts.astype(kind)
    first -= ends
    first += counts.astype(kind, copy=False)
    place = np.repeat(first, counts)
    place += np.arange(len(place), dtype=kind)
    return flat[place]


class Generation(dict):
    """Units by their place among the kept ones; the ids of all lie in one array."""

    def __init__(self) -> None:
        super().__init__()
        self.flat, self.counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        self.bytes = 0

    def add(self, units: list[str], flat: np.ndarray, counts: np.ndarray, size: int) -> None:
        self.update(zip(units, range(len(self), len(self) + len(units)), strict=True))
        self.flat.append(flat.astype(np.int32))
        self.counts.append(counts.astype(np.int32))
        self.bytes += size

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each unit)"""
        if len(self.flat) > 1:
            self.flat, self.counts = [np.concatenate(self.flat)], [np.concatenate(self.counts)]
        return self.flat[0], self.counts[0]

    def places(self, units: list[str]) -> np.ndarray:
        """Where each unit is kept, -1 if it is not."""
        return np.fromiter(map(self.get, units, repeat(-1)), np.int64, len(units))


class Store:
    """Ids by unit, in two generations: the older one goes when the younger holds half of the bytes.

    encode takes distinct units and gives (flat ids, number of ids of each).
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], end_id: int, limit: int = STORE_BYTES):
        self.encode, self.limit = encode, limit
        self.young, self.old = Generation(), Generation()
        self.end = np.array([end_id], np.int32)

    def held(self) -> int:
        """Bytes of both generations."""
        return self.young.bytes + self.old.bytes

    def keep(self, units: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        long = np.fromiter(map(len, units), np.int64, len(units))
        if len(long) and long.max() > LONGEST_KEPT:
            short = long <= LONGEST_KEPT
            units = [u for u, own in zip(units, short.tolist(), strict=True) if own]
            flat, counts, long = flat[np.repeat(short, counts)], counts[short], long[short]
        size = UNIT_BYTES * len(units) + int(long.sum()) + 4 * len(flat)
        if 2 * (self.young.bytes + size) > self.limit:
            self.old, self.young = self.young, Generation()
        if 2 * size <= self.limit:
            self.young.add(units, flat, counts, size)

    def placed(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where in them those of each distinct unit start, how many they are)"""
        parts: list[np.ndarray] = []
        starts, counts, upto = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), 0

        def put(at: np.ndarray, flat: np.ndarray, own_counts: np.ndarray, which: np.ndarray) -> None:
            nonlocal upto
            starts[at] = (np.cumsum(own_counts, dtype=np.int64) - own_counts)[which] + upto
            counts[at] = own_counts[which]
            parts.append(flat)
            upto += len(flat)

        place = self.young.places(units)
        put(np.flatnonzero(place >= 0), *self.young.arrays(), place[place >= 0])
        left = np.flatnonzero(place < 0)
        names = [units[i] for i in left.tolist()]
        if END in names:
            k = names.index(END)
            put(left[k:k + 1], self.end, np.ones(1, np.int64), np.zeros(1, np.int64))
            left = np.delete(left, k)
            del names[k]
        place = self.old.places(names) if self.old else np.full(len(names), -1)
        known = place >= 0
        put(left[known], *self.old.arrays(), place[known])
        again = left[known]
        new = left[~known]
        some = min(NEW_UNITS, self.limit // 2000 + 1)  # so few that the store has room for them
        for a in range(0, len(new), some):
            own = new[a:a + some]
            names = [units[i] for i in own.tolist()]
            flat, n = self.encode(names)
            put(own, flat.astype(np.int32), n, np.arange(len(own)))
            self.keep(names, flat, n)
        flat = np.concatenate([np.zeros(0, np.int32), *parts])
        for a in range(0, len(again), some):
            own = again[a:a + some]
            self.keep([units[i] for i in own.tolist()], gathered_ids(flat, starts[own], counts[own]), counts[own])
        return flat, starts, counts

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct units and the ids of each."""
        flat, starts, counts = self.placed(units)
        return gathered_ids(flat, starts, counts), counts


def list_array(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat.astype(np.int32, copy=False)))


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> list[list[str]]:
    """The batch's texts (null: empty) in runs of about so many characters."""
    out: list[list[str]] = [[]]
    size = 0
    for t in texts.to_pylist():
        if size > chars:
            out.append([])
            size = 0
        out[-1].append(t or "")
        size += len(t or "")
    return out


def cuts(texts: pa.Array, size: int = SLICE_CHARS) -> list[pa.Array]:
    """The batch in slices of about so many bytes; a text is in one slice."""
    bytes_upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    parts = np.concatenate([[0], bytes_upto[:-1] // size])[: len(texts)] if len(texts) else np.zeros(0)
    edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def ids_of_units(units: pa.ListArray, store: Store) -> pa.Array:
    """The ids of each list of units; an END unit gives the end id."""
    each = units.flatten().dictionary_encode()
    flat, starts, counts = store.placed(each.dictionary.to_numpy(zero_copy_only=False).tolist())
    at = each.indices.to_numpy(zero_copy_only=False)
    n = counts.astype(np.int32)[at]
    ends = np.cumsum(n, dtype=np.int32)  # a slice of texts has far fewer ids than 2^31
    upto = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(units).to_numpy(zero_copy_only=False), dtype=np.int64)]
    return list_array(gathered_ids(flat, starts.astype(np.int32)[at], n), np.diff(upto, prepend=0))


def encoded(texts: pa.Array, store: Store, odd: str, units_of_odd: Callable[[str], list[str]], first: str = "", apart: tuple[str, str] | None = None, size: int = SLICE_CHARS) -> pa.Array:
    """The ids of each text (null: empty) and the end id.

    odd is the pattern (RE2) of texts that units_of_odd must cut; first marks the first unit of the others,
    and apart is a pattern and its replacement by which more units are cut from words.
    """
    parts = []
    for run in cuts(texts, size):
        run = pc.fill_null(run, "")
        plain = pc.invert(pc.match_substring_regex(run, odd))
        own = run.filter(plain)
        words = pc.replace_substring_regex(own, *apart) if apart else own
        marked = pc.binary_join_element_wise(first, pc.replace_substring(words, "\n", " \n"), " " + END, "")
        done = ids_of_units(pc.split_pattern(marked, " "), store)
        if len(own) < len(run):
            rest = pa.array([[*units_of_odd(t), END] for t in run.filter(pc.invert(plain)).to_pylist()], pa.list_(pa.string()))
            mask = plain.to_numpy(zero_copy_only=False)
            place = np.where(mask, np.cumsum(mask) - 1, len(own) + np.cumsum(~mask) - 1)
            done = pa.concat_arrays([done, ids_of_units(rest, store)]).take(pa.array(place))
        parts.append(done)
    return pa.concat_arrays(parts)
