"""One query per operator over its whole table, with production parameters, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, chat, decontaminate, grammar, lines, media, merkle, piece_bpe, resample, secret_scan, sharding, subword_lm, toxicity
from .shared import shared_dir, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
N_SHARDS = 16


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document: doc_id, item_id, distance, start, end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.without_boilerplate(docs).select("doc_id", "text", F.col("el_lines_total").alias("n_lines"), F.col("el_lines_dropped").alias("n_dropped"))


SQL_OP2 = f"""
WITH p AS (SELECT doc_id, text, coalesce('h' || source, '-') AS host FROM documents),
     n AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
     l AS (SELECT host, unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''))) AS line FROM p),
     c AS (SELECT host, line, count(*) AS k FROM l GROUP BY host, line HAVING count(*) >= {lines.MIN_PAGES}),
     b AS (SELECT c.host, list(line) AS bad FROM c JOIN n USING (host) WHERE k > pages * CAST({lines.MAX_RATIO} AS DOUBLE) GROUP BY c.host),
     k AS (SELECT doc_id, text, string_split(text, chr(10)) AS own, list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), trim(x, ' '))) AS kept FROM p LEFT JOIN b USING (host))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
       CAST(coalesce(len(own), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(own) - len(kept), 0) AS INTEGER) AS n_dropped
FROM k
"""


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id and the size of its near-duplicate class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bagminhash.classes(docs).select("doc_id", "class_id", "class_size")


def op4_avi_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as an AVI file and read back, with its shots."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw"))
    files = media.write_avi(docs.select("doc_id", "raw"), "raw", "media").select("doc_id", F.length("raw").cast("long").alias("n_bytes"), "media")
    read = media.read_avi(files, "media", "read")
    payload, clips = F.col("read.payload"), F.col("read.clips")
    shots = F.array_join(F.transform(clips, lambda c: F.concat_ws("-", c["start_ms"].cast("string"), c["end_ms"].cast("string"), F.format_number(c["mean_level"], 3))), ",")
    return read.select(
        "doc_id", "n_bytes", F.length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -32, 32)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.col("read.n_frames").cast("string"), shots).alias("feature"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards by fixed virtual slots; law key: doc_id and the shard count decide.

    slot is the gapless place in the shard, vslot the virtual slot, grown_shard the shard under the map's
    version 2 with one shard more, balanced_shard that under version 3, which moves slots by their bytes.
    The versioned map is stored and read back.
    """
    docs = table(spark, sf_dir, "documents")
    path = shared_dir(spark)
    first = sharding.first_map(spark, N_SHARDS)
    balanced = sharding.rebalanced_map(first, sharding.slot_bytes(docs, "doc_id", "text")).withColumn("version", F.lit(3))
    first.unionByName(sharding.grown_map(first, N_SHARDS)).unionByName(balanced).write.partitionBy("version").parquet(path)
    stored = spark.read.schema("vslot int, shard int, version int").parquet(path)
    placed = sharding.placed(docs, stored.where("version = 1").drop("version"), "doc_id", "text")
    later = stored.groupBy("vslot").agg(*(F.max(F.when(F.col("version") == v, F.col("shard"))).alias(name) for v, name in ((2, "grown_shard"), (3, "balanced_shard"))))
    return placed.join(F.broadcast(later), "vslot").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "vslot", "balanced_shard")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    found = secret_scan.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = secret_scan.base_only("spans")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(n(k) for k in secret_scan.BASE_KINDS), F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans"))


PROBE = r"\### Assistant: </turn> ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted, then read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    messages = turns.unionByName(probe).withColumn("parts", chat.text_parts("text"))
    done = chat.formatted_chats(messages).withColumn("turns", chat.parsed_turns("formatted")).withColumn("loss", chat.loss_text("formatted", "loss_spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL_OP7 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')
), s AS (
  SELECT *, len(text) + len(text) - len(replace(text, '\', '')) + len(text) - len(replace(text, '<', ''))
         + len(role) + len(role) - len(replace(role, '\', '')) + len(role) - len(replace(role, '<', '')) + len(role) - len(replace(role, '>', '')) + 16 AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as byte-BPE ids in Re-Pair shards, read back from the files."""
    path = shared_dir(spark)
    grammar.write_ids(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    return grammar.read_ids(spark, path, with_ids=False)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored; the model is learned from labelled rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = piece_bpe.with_text(piece_bpe.with_pieces(docs, PIECE_BPE).select("doc_id", "ids"), PIECE_BPE)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf and proof in the Merkle manifest, folded again from the row or from a tampered copy of it."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", UPPER, UPPER.lower())
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, lowered).otherwise(F.col("text"))
    rows = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": tampered})
    done = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"), merkle.folded("shown_leaf", "path").alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _crc32_sql(byte_list: str) -> str:
    """CRC-32 of a list of bytes, a bit at a time."""
    bits = f"list_transform(range(8 * len({byte_list})), lambda j: ({byte_list}[j // 8 + 1] >> (j % 8)) & 1)"
    return f"xor(list_reduce({bits}, lambda acc, bit: xor(acc >> 1, 3988292384 * (xor(acc, bit) & 1)), 4294967295), 4294967295)"


def _bytes_sql(text: str) -> str:
    return f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"


def _merkle_sql(depth: int = 7, top: int = 3) -> str:
    """The manifest by plain levels: up to 8 ** depth rows of a language and 8 ** top languages."""
    f = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*(f(x) for x in ("doc_id", "source", "lang", "n_chars")), f(text)]) + ")"
    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    ctes = [
        f"b AS (SELECT *, {_bytes_sql('CAST(doc_id AS VARCHAR)')} AS bytes FROM documents)",
        f"d AS (SELECT doc_id, coalesce('l' || lang, '') AS g, {leaf('text')} AS leaf, {leaf(f'CASE WHEN {_crc32_sql('bytes')} % 3 = 0 THEN {lowered} ELSE text END')} AS shown FROM b)",
        "r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d)",
        "a0 AS (SELECT g, pos, leaf AS own, n FROM r)",
    ]
    for k in range(1, depth + 1):
        ctes.append(f"u{k} AS (SELECT g, pos // 8 AS pos, list(own ORDER BY pos) AS members, (max(n) + 7) // 8 AS n FROM a{k - 1} WHERE n > 1 GROUP BY g, pos // 8)")
        ctes.append(f"a{k} AS (SELECT g, pos, sha256(array_to_string(members, '')) AS own, n FROM u{k})")
    ctes.append("s AS (SELECT *, row_number() OVER (ORDER BY g) - 1 AS pos0, count(*) OVER () AS n0 FROM (" + " UNION ALL ".join(f"SELECT g, own FROM a{k} WHERE n = 1" for k in range(depth + 1)) + "))")
    ctes.append("z0 AS (SELECT pos0 AS pos, own, n0 AS n FROM s)")
    for k in range(1, top + 1):
        ctes.append(f"y{k} AS (SELECT pos // 8 AS pos, list(own ORDER BY pos) AS members, (max(n) + 7) // 8 AS n FROM z{k - 1} WHERE n > 1 GROUP BY pos // 8)")
        ctes.append(f"z{k} AS (SELECT pos, sha256(array_to_string(members, '')) AS own, n FROM y{k})")
    ctes.append("root AS (" + " UNION ALL ".join(f"SELECT own AS root FROM z{k} WHERE n = 1" for k in range(top + 1)) + ")")
    steps = [(f"u{k}", f"u{k}.g = r.g AND u{k}.pos = r.pos // {8 ** k}", f"r.pos // {8 ** (k - 1)} % 8", k) for k in range(1, depth + 1)]
    steps += [(f"y{k}", f"y{k}.pos = s.pos0 // {8 ** k}", f"s.pos0 // {8 ** (k - 1)} % 8", depth + k) for k in range(1, top + 1)]
    cut = lambda t, at: (f"array_to_string({t}.members[1:CAST({at} AS INTEGER)], '')", f"array_to_string({t}.members[CAST({at} AS INTEGER) + 2:], '')")
    ctes.append("p AS (SELECT r.doc_id, r.leaf, r.shown, s.own AS subroot, root.root, " + ", ".join(f"{t}.n IS NOT NULL AS up{k}, coalesce({cut(t, at)[0]}, '') AS before{k}, coalesce({cut(t, at)[1]}, '') AS after{k}" for t, _, at, k in steps) + " FROM r JOIN s ON s.g = r.g CROSS JOIN root " + " ".join(f"LEFT JOIN {t} ON {on}" for t, on, _, _ in steps) + ")")
    last = "p"
    for _, _, _, k in steps:
        ctes.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN up{k} THEN sha256(before{k} || shown || after{k}) ELSE shown END AS shown) FROM {last})")
        last = f"f{k}"
    proof = " || ".join(f"before{k} || after{k}" for *_, k in steps)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, shown AS folded_root, shown = root AS verified FROM {last}"


def op12_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by the lattice of subwords, and by add-one counts of words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = subword_lm.fit(docs, PIECE_BPE)
    done = subword_lm.scored(docs, model)
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.sums["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark's distribution, and the rank of those drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resampled(docs, table(spark, sf_dir, "benchmark"))


SQL_OP13 = rf"""
WITH w AS (SELECT doc_id, text, unnest(words) AS word FROM (SELECT doc_id, text, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents)),
     v AS (SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
     k AS (SELECT word, {_bytes_sql('word')} AS bytes FROM (SELECT word FROM w UNION SELECT word FROM v)),
     h AS (SELECT word, {_crc32_sql('bytes')} % {resample.BUCKETS} AS bucket FROM k),
     s AS (SELECT bucket, count(*) AS s FROM w JOIN h USING (word) GROUP BY bucket),
     t AS (SELECT bucket, count(*) AS t FROM v JOIN h USING (word) GROUP BY bucket),
     g AS (SELECT bucket, CAST(floor(1000.0::DOUBLE * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {resample.BUCKETS})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {resample.BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
     x AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN h USING (word) JOIN g USING (bucket) GROUP BY doc_id),
     y AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE AS h FROM documents LEFT JOIN x USING (doc_id)),
     z AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM y),
     r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= {resample.LEAST_WORDS})
SELECT z.doc_id, n_features, weight, score, CASE WHEN rank <= n * {resample.PERCENT} // 100 THEN rank END AS rank FROM z LEFT JOIN r ON r.doc_id = z.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_decontamination, op2_line_dedup, op3_near_dedup, op4_avi_mjpeg, op5_sharding,
        op6_secrets, op7_chat, op8_token_ids, op9_toxicity, op10_sentencepiece,
        op11_merkle, op12_subword_lm, op13_resample,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": SQL_OP2, "op7_chat": SQL_OP7, "op11_merkle": _merkle_sql(), "op13_resample": SQL_OP13}
