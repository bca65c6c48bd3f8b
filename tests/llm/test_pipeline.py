"""The pipeline's stages, each against a brute-force version on its own input, and the queries' contracts."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__
import corpus_pipeline
from eventloom.llm import decontaminate, lines, toxicity
from eventloom.llm.shared import table

from .test_operators import brute_classes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        out.append((name, before, docs))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(stages):
    assert [n for n, *_ in stages] == ["toxicity", "line dedup", "near-dedup", "decontamination", "sentencepiece"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    _, before, after = stages[0]
    kept, all_ = by_id(after), by_id(before)
    scores = {r.doc_id: r.score for r in toxicity.scored(before, toxicity.fit(before, table(spark, SF, "labels"))).collect()}
    assert set(kept) == {i for i, s in scores.items() if s < toxicity.REJECT} and all(kept[i] == all_[i] for i in kept)
    clean = [r.doc_id for r in table(spark, SF, "labels").where("toxic = 0").collect()]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_boilerplate_goes(stages):
    _, before, after = stages[1]
    rows, got = by_id(before), by_id(after)
    pages = Counter(r.source for r in rows.values())
    holds = Counter((r.source, x) for r in rows.values() for x in {y.strip(" ") for y in (r.text or "").split("\n")} - {""})
    bad = {k for k, n in holds.items() if n >= lines.MIN_PAGES and n > pages[k[0]] * lines.MAX_RATIO}
    assert set(got) == set(rows)
    for i, r in rows.items():
        want = "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in bad)
        assert got[i].text == want and got[i].n_chars == (r.n_chars if want == r.text else len(want))


def test_one_of_each_class_stays(stages):
    _, before, after = stages[2]
    rows = by_id(before)
    assert set(by_id(after)) == set(brute_classes([(i, r.text) for i, r in rows.items()]).values())


def test_documents_with_items_go(spark, stages):
    _, before, after = stages[3]
    kept = by_id(after)
    items = [decontaminate.plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = {g for x in items for g in zip(*[x.split(" ")[k:] for k in range(5)], strict=False)}
    for i, r in by_id(before).items():
        words = decontaminate.plain(r.text)
        if any(x in words for x in items):
            assert i not in kept
        elif not grams & set(zip(*[words.split(" ")[k:] for k in range(5)], strict=False)):
            assert kept[i] == r


def test_pieces_are_the_librarys(stages):
    _, before, after = stages[4]
    sp, got = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), by_id(after)
    for i, r in by_id(before).items():
        want = sp.encode(r.text, add_eos=True)
        assert got[i].ids == want and got[i].n_tokens == len(want)
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == {i: r.ids_sha256 for i, r in by_id(stages[-1][2]).items()}


EDGES = [
    (1, "plain words of a text that stays as it is", "en", "s", 41), (1, "plain words of a text that stays as it is", "en", "s", 41), (2, None, None, None, None), (3, "", "en", "s", 0),
    (None, "a text without an id but with words enough to have shingles", None, "s", None), (4, "You are an idiot, idiot, idiot.", "en", "s", 31), (5, "\n\n \t\n", "en", None, 6), (6, "long " * 60_000, "en", "s", 300_000),
    (7, "tie of equal words in two documents of one size", "en", "s", 9), (8, "tie of equal words in two documents of one size", "en", "s", 9),
]


@pytest.mark.parametrize("rows", [EDGES, []])
def test_stages_take_nulls_empty_long_and_repeated_texts_and_clashing_names(spark, tmp_path, rows):
    names = "el_score el_x el_total el_dropped el_lines_dropped el_host el_id el_key el_leak".split()
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'{n} int' for n in names)}")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, str(tmp_path)).cache()
        assert after.columns == df.columns and {tuple(r) for r in after.collect()} <= {tuple(r) for r in df.collect()}
        df = after
    got = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).collect()
    assert sorted(r.doc_id or 0 for r in got) == ([0, 1, 2, 5, 6, 7] if rows else [])  # 4 is toxic, 3 a copy of 2; 5 has no words and no equal
    assert all(r.n_tokens == len(r.ids) and r.ids[-1] == 2 for r in got)


def test_queries_return_their_contracts(spark):
    queries = __spark_entry__.queries()
    names = {int(n[2:].split("_")[0]): n for n in queries if n.startswith("op")}
    assert sorted(names) == list(range(1, 14)) and "pipeline" in queries
    docs = by_id(table(spark, SF, "documents"))
    texts = {i: r.text or "" for i, r in docs.items()}
    for i, r in by_id(queries[names[4]](spark, SF)).items():
        raw = texts[i].encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    rows = by_id(queries[names[5]](spark, SF))
    assert all(r.law == "key" and r.size == len(texts[i].encode()) + 1 and r.grown_shard in (r.shard, 16) for i, r in rows.items())
    for s in range(16):
        assert sorted(r.slot for r in rows.values() if r.shard == s) == list(range(sum(r.shard == s for r in rows.values())))
    import numpy as np
    from tokenizers import Tokenizer

    bpe, sp = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in by_id(queries[names[10]](spark, SF)).items():
        ids = sp.encode(texts[i], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    start = 0
    for i, r in sorted(by_id(queries[names[8]](spark, SF)).items()):
        ids = np.array([*bpe.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += r.n_tokens
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in by_id(queries[names[9]](spark, SF)).items())
    probe = {r.conv_id: r for r in queries[names[7]](spark, SF).collect()}[-7]
    said = r"\### Assistant: </turn> ok"
    assert (probe.n_turns, probe.loss_chars, probe.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert {r.doc_id for r in queries[names[3]](spark, SF).collect()} == set(docs)
