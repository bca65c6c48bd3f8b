"""Merkle manifest, subword lattice scores and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from eventloom.llm import merkle, queries, resample, subword_lm

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, row long, word string, pos int, grp string, rank int, bucket int, n int"
WORDS = "the of and wetherin Moluk ÄÖß 漢字 tha'n x9 zebrafish under_score 🙂".split()


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    texts += [None, "", " ", "\n\t", "A", "a", "same text here", "same text here", "\x00\x1f a b c", "word" * 5_000, "the " * 30_000]
    out = [(i, t, f"s{i % 3}" if i % 7 else None, [None, "de", "en", "en", "en", "en", "zz", ""][i % 8], i if i % 5 else None) for i, t in enumerate(texts)]
    out += [(3, texts[3], "s0", "en", 3), (3, "another text of the same id", None, "en", None), (None, "no id", "s", "en", 1), (None, None, None, None, None), (-5, "negative", "s", "only", 2)]
    return [(*r, 1, "w", 2, "g", 3, 4, 5) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 11: Merkle manifest


def climbed(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """(the last node, every leaf's steps)."""
    steps, place, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, at in enumerate(place):
            run = level[at // 8 * 8:at // 8 * 8 + 8]
            steps[i].append(("".join(run[:at % 8]), "".join(run[at % 8 + 1:])))
            place[i] = at // 8
        level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
    return level[0], steps


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def expected_manifest(rows: list[tuple]) -> list[tuple]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups: dict = {}
    for d, text, source, lang, n_chars in rows:
        leaf = lambda t: sha("".join(map(field, (d, source, lang, n_chars, t))))  # noqa: B023, E731
        shown = text.translate(lower) if text is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else text
        groups.setdefault(lang, []).append((d, leaf(text), leaf(shown)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    below = {g: climbed([leaf for _, leaf, _ in groups[g]]) for g in order}
    root, above = climbed([below[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (d, leaf, shown) in enumerate(groups[g]):
            path, own = below[g][1][i] + above[k], shown
            for before, after in path:
                own = sha(before + own + after)
            out.append((d, leaf, below[g][0], root, sha("".join(b + a for b, a in path)), own, own == root))
    return out


def made_manifest(df, **names) -> list[tuple]:
    lowered = F.translate("text", queries.UPPER, queries.UPPER.lower())
    shown = {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered).otherwise(F.col("text"))}
    got = merkle.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", shown, **names)
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path"), merkle.folded("shown_leaf", "path").alias("f"))
    return [(*r, r["f"] == r["root"]) for r in got.collect()]


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("levels", "top"), [(4, 4096), (1, 10_000), (1, 8), (2, 8), (1, 3)])
def test_manifest_whatever_the_blocks_and_the_top(docs, rows, levels, top):
    """Few nodes for the driver force several distributed rounds, also over the subroots."""
    assert in_order(made_manifest(docs, levels=levels, top=top)) == in_order(expected_manifest([r[:5] for r in rows]))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_manifest_of_one_group(spark, n):
    own = [(i, f"Text {i}", "s", "en", i) for i in range(n)]
    df = spark.createDataFrame(own, "doc_id long, text string, source string, lang string, n_chars long")
    assert in_order(made_manifest(df, levels=1, top=2)) == in_order(expected_manifest(own))


def test_manifest_of_nothing_and_of_many_groups(spark, empty):
    assert made_manifest(empty) == []
    own = [(i, "A", None, f"g{i:03}", None) for i in range(90)]
    df = spark.createDataFrame(own, "doc_id long, text string, source string, lang string, n_chars long")
    assert in_order(made_manifest(df, levels=1, top=5)) == in_order(expected_manifest(own))


def test_a_changed_row_or_proof_does_not_verify(spark):
    own = [(i, f"text {i}", "s", "en", i) for i in range(20)]
    df = spark.createDataFrame(own, "doc_id long, text string, source string, lang string, n_chars long")
    got = merkle.manifest(df, ["doc_id", "text"], "lang", "doc_id").select("leaf", "root", "path", merkle.folded("leaf", "path").alias("f"), merkle.folded(F.sha2("leaf", 256), "path").alias("other"))
    assert all(r["f"] == r["root"] != r["other"] for r in got.collect())


# 12: subword lattices


def likelihoods(words: list, pieces, log_p) -> np.ndarray:
    out = np.zeros(len(words))
    for at, part in subword_lm.lattices([w if isinstance(w, bytes) else w.encode() for w in words], pieces):
        part.weigh(log_p)
        out[at] = part.likelihood()
    return out


def test_lattices_sum_all_spellings():
    pieces = subword_lm.Pieces(PIECE_BPE)
    known = {"".join(chr(int(c)) for c in chars): int(i) for _, _, ids, all_ in pieces.known.values() for i, chars in zip(ids, all_, strict=True)}
    p = np.exp(pieces.start)

    def spelled(text: str, counts: Counter | None = None) -> dict:
        """{pieces used: probability} of every spelling."""
        if not text:
            return {(): 1.0}
        out = {}
        for n in range(1, min(len(text), pieces.longest) + 1):
            ids = (known[text[:n]],) if text[:n] in known else tuple(pieces.byte[b] for b in text[0].encode()) if n == 1 else None
            if ids:
                own = math.prod(p[i] for i in ids)
                for rest, q in spelled(text[n:]).items():
                    out[ids + rest] = out.get(ids + rest, 0) + own * q
        return out

    words = ["the", "a", "wetherin", "ÄÖß", "漢字𠀀", "🙂", "x9", "▁_▁", "\x01"]
    all_ = [spelled("▁" + w) for w in words]
    assert np.allclose(likelihoods(words, pieces, pieces.start), [math.log(sum(x.values())) for x in all_])
    counts = np.arange(1.0, len(words) + 1)
    uses = np.zeros(pieces.size)
    for n, x in zip(counts, all_, strict=True):
        for ids, q in x.items():
            for i in ids:
                uses[i] += n * q / sum(x.values())
    got = np.zeros(pieces.size)
    for at, part in subword_lm.lattices([w.encode() for w in words], pieces):
        part.weigh(pieces.start)
        got += part.expected(counts[at])
    assert np.allclose(got, uses)
    assert abs(np.exp(pieces.start).sum() - 1) < 1e-9


def test_words_are_cut_alike_in_slices(monkeypatch):
    raw = ("The  a\tb\x0b\x0cC\r\n" * 50 + "tail" * 40).encode()
    whole = subword_lm.word_counts(raw)
    for n in (1, 2, 7, 50):
        monkeypatch.setattr(subword_lm, "SLICE_BYTES", n)
        assert subword_lm.word_counts(raw) == whole
    assert whole["a".encode()] == 50 and whole[b"tail" * 40] == 1 and subword_lm.word_counts(None) == {}


@pytest.mark.parametrize("hot", [1, 12, 1 << 16])
def test_scores_against_counting(spark, docs, rows, monkeypatch, hot):
    """Words looked up in the broadcast and words joined give the same sums."""
    monkeypatch.setattr(subword_lm, "HOT", hot)
    model = subword_lm.fit(docs, PIECE_BPE, rounds=2)
    got = sorted(([*r] for r in subword_lm.scored(docs, model).collect()), key=repr)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    trained, ends = Counter(), 0
    for d, text, *_ in rows:
        if not held(d):
            trained.update((text or "").encode().lower().split())
            ends += 1
    n_all, v = trained.total() + ends, len(trained) + 1
    pieces = subword_lm.Pieces(PIECE_BPE)
    spelled = (sum(c == 1 for c in trained.values()) + 1) / (trained.total() + 2)
    words = sorted({w for _, t, *_ in rows for w in (t or "").encode().lower().split()})
    own = {w: math.log10((1 - (ends + 1) / (n_all + 2)) * (spelled * math.exp(x) + (1 - spelled) * trained[w] / trained.total())) if x > -700 else None for w, x in zip(words, likelihoods(words, pieces, model.log_p), strict=True)}
    want = []
    for d, text, *_ in rows:
        doc = (text or "").encode().lower().split()
        base = sum(math.log10((c + 1) / (n_all + v + 1)) for c in [*(trained[w] for w in doc), ends])
        want.append([d, held(d), len(doc) + 1, sum(trained[w] > 0 for w in doc) + 1, base, math.log10((ends + 1) / (n_all + 2)) + sum(own[w] or 0 for w in doc), any(own[w] is None for w in doc)])
    for g, w in zip(got, sorted(want, key=lambda x: repr(x[:-1])), strict=True):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-6 * max(1, abs(w[4])) and (w[6] or abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])))
        assert math.isfinite(g[5]) and g[5] < 0


def test_pieces_fitted_to_a_corpus_explain_it_better(spark):
    rng = random.Random(3)
    own = [(i, " ".join("mol" * rng.randint(1, 3) + rng.choice(["kip", "sou", "vel"]) for _ in range(30))) for i in range(40)]
    df = spark.createDataFrame(own, "doc_id long, text string")
    at = [subword_lm.fit(df, PIECE_BPE, rounds=n) for n in (0, 1, 3)]
    words = [bytes(r["word"]) for r in at[0].words.collect()]
    pieces = subword_lm.Pieces(PIECE_BPE)
    seen = [likelihoods(words, pieces, model.log_p).sum() for model in at]
    assert seen[0] < seen[1] < seen[2]


def test_scores_of_nothing(spark, empty):
    assert subword_lm.scored(empty, subword_lm.fit(empty, PIECE_BPE)).collect() == []
    held = spark.createDataFrame([(i, "the word") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in subword_lm.scored(held, subword_lm.fit(held, PIECE_BPE)).collect())


# 13: importance resampling


def expected_draw(rows: list[tuple], target: list[str], longest: int, least: int, percent: int) -> list[tuple]:
    def features(text: str | None) -> tuple[int, list[bytes]]:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        words, word = [], b""
        for b in raw + b" ":
            if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F:
                words += [word] if word else []
                word = b""
            else:
                word += bytes([b])
        return len(words), [b" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    bucket = lambda f: zlib.crc32(f) % 10_000
    s, t = Counter(), Counter()
    own = [(d, *features(text)) for d, text, *_ in rows]
    for *_, fs in own:
        s.update(map(bucket, fs))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    out = []
    for d, n, fs in own:
        h = int(sha(f"2024:{'' if d is None else d}")[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        out.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = {id(x): k for k, x in enumerate(fit[:percent * len(fit) // 100], 1)}
    return [(*x[:4], drawn.get(id(x))) for x in out]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (2, 35), (3, 100)])
def test_draw_against_counting(spark, docs, rows, longest, percent):
    target = ["the zebrafish of Moluk", None, "", "and and under_score x9"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(docs, bench, longest=longest, percent=percent).collect()
    want = expected_draw(rows, target, longest, 20, percent)
    assert in_order([tuple(r)[:4] for r in got]) == in_order([w[:4] for w in want])
    once = lambda x: sorted(((r[3], r[4]) for r in x if r[4]), key=lambda p: p[1])
    assert once(got) == once(want)


def test_runs_are_counted_alike_in_slices(monkeypatch):
    raw = ("One two-three, four" + " five" * 20).encode() * 5
    for longest in (1, 2, 4):
        monkeypatch.setattr(resample, "SLICE_BYTES", 1 << 20)
        whole = resample.bucket_counts(raw, longest, 10_000, {})
        for n in (1, 9, 40):
            monkeypatch.setattr(resample, "SLICE_BYTES", n)
            monkeypatch.setattr(resample, "KNOWN_RUNS", 3)
            assert resample.bucket_counts(raw, longest, 10_000, {}) == whole
    assert resample.bucket_counts(None, 2, 10_000, {}) == (0, Counter())


def test_draw_of_nothing_and_for_nothing(spark, docs, empty):
    bench = spark.createDataFrame([], "text string")
    assert resample.resampled(empty, bench).collect() == []
    assert resample.resampled(docs, bench).count() == docs.count()


def test_new_queries_return_their_contracts(spark):
    sf, q = "/root/testdata/sf0.001", queries.queries()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    kinds = {
        "op11_merkle": "doc_id:bigint leaf:string subroot:string root:string proof_sha256:string folded_root:string verified:boolean",
        "op12_subword_lm": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
        "op13_resample": "doc_id:bigint n_features:bigint weight:bigint score:bigint rank:bigint",
    }
    for name, want in kinds.items():
        got = q[name](spark, sf)
        assert " ".join(f"{c}:{k}" for c, k in got.dtypes) == want and got.count() == n


@pytest.mark.parametrize("name", ["op11_merkle", "op13_resample"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want, got = con.sql(queries.oracle_sql()[name]), queries.queries()[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert in_order([tuple(r[c] for c in columns) for r in got.collect()]) == in_order(want.project(", ".join(columns)).fetchall())
