"""All named queries of the library proper, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.plans import asked, careers, charts, derive, golden, intake, kicking, panels, reports, surfaces, texts, tools, verification  # noqa: F401  they register their queries
from eventloom.plans.registry import ORACLE, QUERIES

FLAGSHIP = "q23_kick_outcomes"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
