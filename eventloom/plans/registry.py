"""The registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.plans.binding import Tables, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None, play_tables: bool = True):
    """Register f(tables) under name, with the oracle's SQL over the play-shaped (or the given) tables."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle:
            ORACLE[name] = sql(oracle) if play_tables else oracle
        return f

    return add
