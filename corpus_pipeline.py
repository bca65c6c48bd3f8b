"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination and tokens over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written
as Parquet and read again.  All stages but the last return the columns of documents, and other columns
that docs may have, whatever their names.

Defined results of every stage: a null text counts as an empty one, and stays null as long as it is kept;
texts are read whole, however long; rows with null ids are kept unless another of their near-duplicate
class is; of rows of one id and one text near-dedup keeps one; ties are broken as the operators say; an
empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bagminhash, decontaminate, lines, piece_bpe, toxicity
from eventloom.llm.shared import fresh, saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the model is learned from the labelled ones among docs."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "el_score")
    return toxicity.scored(docs, model, score=score).where(F.col(score) < toxicity.REJECT).select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text."""
    total, dropped = fresh(docs, "el_total", "el_dropped")
    left = lines.without_boilerplate(docs, total=total, dropped=dropped)
    return left.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of the least id."""
    return bagminhash.one_of_each(docs).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it: doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = piece_bpe.with_text(piece_bpe.with_pieces(docs, path).select("doc_id", "lang", "source", "ids"), path)
    return done.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: SQL can express neither the learned scores nor the sketches; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents: a row of ids for every document that is left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
