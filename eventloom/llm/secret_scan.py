"""Secret scans: fixed patterns plus sliding-window Shannon entropy per character class.

Candidate strings are maximal runs of token characters, split at = / - _ into parts.  In each part a
window slides over the maximal runs of each class's alphabet (hex, letters of one case with digits,
base64); its entropy comes from incremental counts (one character enters, one leaves).  Windows with the
bits per character of their class and length merge into a span; runs shorter than the long window take
the short one.  The whole candidate is read as base64 too, as base64 may hold the separators.  An
allow-list, and a least number of changes between letters and digits where the bits asked for are few,
suppress candidates that look random without being secret.

Defined results: null and empty texts have no spans; texts are scanned whole, however long; repeated
rows each get their spans; an empty table gives an empty result; other columns are not touched, but
for one that has the name asked for, which is replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import small_batches

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_alnum")
BASE_KINDS = KINDS[:3]
#: Bits per character by class and window: what at least 98 in 100 random windows of the class have.
BITS = {"hex": {24: 3.0, 16: 2.65}, "alnum": {24: 3.6, 16: 3.1}, "base64": {24: 3.85, 16: 3.3}}
#: Bits and window of a whole candidate read as base64.
WHOLE_BITS, WHOLE_WINDOW = 4.15, 24
#: Runs of a class, and changes between letters and digits that each has at least.
RUN = {"hex": re.compile(r"[0-9a-fA-F]{16,}"), "alnum": re.compile(r"[a-z0-9]{16,}|[A-Z0-9]{16,}"), "base64": re.compile(r"[A-Za-z0-9+]{16,}")}
LEAST_CHANGES = {"hex": 1, "alnum": 3, "base64": 2}
#: Candidates that are not secrets, by full match: words of letters alone in ordinary case, numbers,
#: paths and dotted names of such words, and UUIDs.  Separators are no letters, so no step is ever taken back.
ALLOWED = re.compile(
    r"[A-Z]?[a-z]++(?:[/_+=-]++[A-Z]?[a-z]*+)*+"
    r"|[A-Z]++(?:[/_+=-]++[A-Z]*+)*+"
    r"|[0-9]++(?:[/_+=-]++[0-9]*+)*+"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs: a shorter one is no match and holds no longer one
_part = re.compile(r"[^=/_-]{16,}")
_change = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_code = np.zeros(128, bool)
_code[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_hexes = frozenset("0123456789abcdefABCDEF")
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def runs_of(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def entropy_spans(token: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of token whose entropy is at least bits a character, from incremental counts."""
    if len(token) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(token):
        if i >= window:  # one leaves before one enters: no count ever passes the window
            out = token[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += term[n - 1] - term[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= window - 1 and math.log2(window) - total / window >= bits:
            if spans and spans[-1][1] >= i - window + 1:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i - window + 1, i + 1))
    return spans


def candidate_spans(token: str) -> list[tuple[int, int, str]]:
    """(start, end, class) of the entropy spans of one candidate, those of a class merged."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BITS}
    if not _hexes.issuperset(token):
        found["base64"] += entropy_spans(token, WHOLE_WINDOW, WHOLE_BITS)
    for part in _part.finditer(token):
        if ALLOWED.fullmatch(part[0]):
            continue
        taken: set[tuple[int, int]] = set()  # a run is read once, in the narrowest class
        for kind, runs in RUN.items():
            for m in runs.finditer(part[0]):
                if m.span() not in taken and sum(1 for _ in _change.finditer(m[0])) >= LEAST_CHANGES[kind]:
                    a, window = part.start() + m.start(), 24 if len(m[0]) >= 24 else 16
                    found[kind] += [(a + x, a + y) for x, y in entropy_spans(m[0], window, BITS[kind][window])]
                taken.add(m.span())
    out = []
    for kind, spans in found.items():
        last = -1
        for a, b in sorted(spans):
            if a <= last:
                out[-1] = (out[-1][0], max(out[-1][1], b), kind)
            else:
                out.append((a, b, kind))
            last = out[-1][1]
    return out


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, order of the kind, end) of every span of one text."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    for a, b in runs_of(_code[np.minimum(codes, 127)] & (codes < 128), 16):
        token = text[a:b]
        if b - a >= 32:
            found += [(a + m.start(), 2, a + m.end()) for m in HEX.finditer(token)]
        if ALLOWED.fullmatch(token):
            continue
        found += [(a + x, KINDS.index(f"entropy_{kind}"), a + y) for x, y, kind in candidate_spans(token)]
    return sorted(found)


@F.arrow_udf(SPANS)
def _scan(texts: pa.Array) -> pa.Array:
    out = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t.as_py() or "")] for t in texts]
    return pa.array(out, pa.list_(SPAN))


def with_secrets(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """df with spans: every secret of the whole text as (kind, start, end), by start, then kind."""
    return small_batches(df).withColumn(spans, _scan(F.coalesce(F.col(text), F.lit(""))))


def base_only(spans: str | Column) -> Column:
    return F.filter(F.col(spans) if isinstance(spans, str) else spans, lambda s: s["kind"].isin(*BASE_KINDS))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
