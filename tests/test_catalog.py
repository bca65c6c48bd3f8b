"""Every registered query of the library proper against its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from eventloom import catalog

SF = Path("/root/testdata/sf0.001")
SCALES = ("sf0.001", "sf0.01")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the given tables are not here")


def opened(folder: Path):
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="module")
def duck():
    return opened(SF)


@pytest.fixture(scope="module")
def ducks():
    return {scale: opened(SF.parent / scale) for scale in SCALES}


def plain(v):
    return "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, ducks, name, scale):
    df = catalog.queries()[name](spark, str(SF.parent / scale))
    want = ducks[scale].sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    place = [want.columns.index(c) for c in columns]
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == sorted(tuple(plain(r[i]) for i in place) for r in want.fetchall())


def test_two_sample_difference(spark, duck):
    from eventloom.plans.binding import sql

    r = catalog.queries()["r07_two_sample"](spark, str(SF)).first()
    a, va, na, b, vb, nb = duck.sql(sql("SELECT avg(punt_gross_yds) FILTER (WHERE surface = 'grass'), var_samp(punt_gross_yds) FILTER (WHERE surface = 'grass'), count(*) FILTER (WHERE surface = 'grass'), avg(punt_gross_yds) FILTER (WHERE surface = 'turf'), var_samp(punt_gross_yds) FILTER (WHERE surface = 'turf'), count(*) FILTER (WHERE surface = 'turf') FROM play_wide WHERE play_kind = 'punt'")).fetchall()[0]
    assert (r.n_a, r.n_b) == (na, nb) and r.difference == pytest.approx(a - b) and r.se == pytest.approx((va / na + vb / nb) ** 0.5)
    assert r.low < r.difference < r.high


def test_dimension_joins_do_not_shuffle_the_fact_twice(spark):
    """Small dimensions are broadcast by their measured size; the scans read only the columns that are used."""
    df = catalog.queries()["q18_leaders_rush_yards"](spark, str(SF))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "l_comment" not in plan and "ReadSchema" in plan
