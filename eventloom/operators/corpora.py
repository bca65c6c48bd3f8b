"""Corpora that never mix: one store of all, a view or a copy of each.

Games say which corpus they are of.  Facts follow their game, bridges their fact, and shared dimensions
are cut to what a corpus's games name, so that no question asked of one corpus meets another's rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.load import LoadRefused


def part(corpus: str, games: DataFrame, facts: Mapping[str, DataFrame], bridges: Mapping[str, tuple[DataFrame, str]] | None = None, shared: Mapping[str, tuple[DataFrame, str]] | None = None, column: str = "league", game: str = "game_id", uid: str = "play_uid") -> dict[str, DataFrame]:
    """The tables of one corpus by name, without the column that names it.

    facts have the column themselves; bridges are (frame, its fact) and keep the rows of that fact's plays;
    shared dimensions are (frame, key) and keep the rows whose key a game of the corpus has.
    """
    own = games.where(F.col(column) == corpus).drop(column)
    out = {"games": own} | {name: df.where(F.col(column) == corpus).drop(column) for name, df in facts.items()}
    out |= {name: df.join(out[fact].select(uid), uid, "left_semi") for name, (df, fact) in (bridges or {}).items()}
    return out | {name: df.join(own.select(key), key, "left_semi") for name, (df, key) in (shared or {}).items()}


def refuse_loss(whole: DataFrame, parts: list[DataFrame]) -> None:
    """The rows of all parts are the rows of the whole, with multiplicity: told by counts and a checksum, then by the rows."""
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    lost, extra = whole.select(together.columns).exceptAll(together).count(), together.exceptAll(whole.select(together.columns)).count()
    if lost or extra:
        raise LoadRefused(f"the parts lack {lost} rows of the whole and have {extra} of their own")


def attach(spark: SparkSession, base: str, corpora: list[str], tables: list[str], column: str = "league") -> list[str]:
    """Views <corpus>_<table> over tables stored below base and partitioned by column: each reads its own partition only."""
    made = []
    for name in tables:
        stored = spark.read.parquet(f"{base}/{name}")
        for corpus in corpora:
            stored.where(F.col(column) == corpus).drop(column).createOrReplaceTempView(f"{corpus}_{name}")
            made.append(f"{corpus}_{name}")
    return made
