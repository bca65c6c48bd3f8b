"""What a task holds does not grow with the tables: plays are dealt by their number, and a step reads them once."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom import catalog
from eventloom.operators import compare, events
from eventloom.plans import binding

SF = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SF.exists(), reason="the given tables are not here")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> int:
    return plan(df).count("lineitem.parquet")


@needs_tables
def test_a_larger_table_makes_more_tasks_not_larger_ones(spark, monkeypatch):
    monkeypatch.setattr(binding, "TASK_ROWS", 200)
    t = binding.Tables(spark, str(SF))
    n = t.raw("lineitem").count()
    assert t.tasks == -(-n // 200) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = [r["n"] for r in t.plays.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(held) == n and max(held) < 2 * 200
    assert t.plays.select("game_id", F.spark_partition_id().alias("p")).distinct().groupBy("game_id").count().where("count > 1").count() == 0
    monkeypatch.setattr(binding, "TASK_ROWS", n)
    assert binding.Tables(spark, str(SF)).tasks is None


@needs_tables
def test_drives_are_dealt_to_no_more_tasks_than_a_shuffle_is_written_straight_to_files_for(spark, monkeypatch):
    """One partition more than the threshold, and a task that reads the plays holds all it has read."""
    q24 = catalog.queries()["q24_drive_outcomes"]
    want = rows(q24(spark, str(SF)))
    monkeypatch.setattr(binding, "TASK_ROWS", 10)
    most = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    t = binding.Tables(spark, str(SF))
    assert t.raw("lineitem").count() / 10 > most >= t.tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = q24(spark, str(SF))
    dealt = [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan(df))]
    assert max(dealt) <= most and plan(df).count("hashpartitioning(") == len(dealt) + 1  # and once by zone: drives stay where their plays lie
    assert rows(df) == want and len(want) == 5


def test_conversions_emitted_by_rows_equal_those_of_frames_in_one_pass(spark):
    from eventloom.operators import conversions

    schema = "base_uid string, game_id int, k int, home_team_id int, away_team_id int, play_type string, play_text string, scoring boolean, home_points int, away_points int, start_team_id int, yards int, home_before int, away_before int"
    kinds = ["Two Point Pass", "Kickoff", "Rushing Touchdown", "Defensive 2pt Conversion", None, "Kickoff Touchdown"]
    feed = spark.createDataFrame([(f"g:{i % 4}", i % 3, i, 10, 20, kinds[i % 6], ("good", None, "Two-Point try failed", "kick attempt")[i % 4], (True, None, False)[i % 3], i % 2 * 2, i % 5, (10, 20, None)[i % 3], i, 7, i) for i in range(60)], schema)
    kick = {"play_kind": F.lit("kickoff"), "converted": F.lit(None).cast("boolean"), "two_point_type": F.lit(None).cast("string"), "parse_confidence": F.lit("exact")}
    is_kick, scores = F.col("play_type").startswith("Kickoff"), ["Rushing Touchdown", "Kickoff Touchdown"]
    kicks = conversions.sided(feed.where(is_kick).withColumn("scorer", F.lit(None).cast("int"))).withColumns(kick)
    want = conversions.emitted(kicks, feed, ["k"], scores, ["yards"]).drop("scorer")
    got = conversions.emitted_by(feed, is_kick, kick, ["k"], scores, ["yards"])
    assert rows(got.select(want.columns)) == rows(want) and got.where("play_kind = 'pat'").count() > 3  # a kickoff returned for a score emits two rows


@needs_tables
def test_conversions_read_and_sort_the_plays_once(spark):
    df = catalog.queries()["e06_conversions"](spark, str(SF))
    assert scans(df) == 1 and "Union" not in plan(df)


@needs_tables
@pytest.mark.parametrize("name", ["e18b_next_snap_after_kickoff"])
def test_the_next_snap_is_found_in_one_pass_over_both_facts(spark, name):
    df = catalog.queries()[name](spark, str(SF))
    assert scans(df) == 1 and "Union" not in plan(df)


@needs_tables
@pytest.mark.parametrize("name", ["r04_kickoff_era", "r05n_kickoff_men"])
def test_kickoffs_carry_their_columns_to_the_next_snap(spark, name):
    """Neither facts are laid together nor kickoffs joined by uid."""
    df = catalog.queries()[name](spark, str(SF))
    assert "Union" not in plan(df) and "hashpartitioning(play_uid" not in plan(df)


@needs_tables
@pytest.mark.parametrize("name", ["e15b_whole_drives", "q24b_drive_results"])
def test_whole_drives_read_the_plays_once(spark, name):
    df = catalog.queries()[name](spark, str(SF))
    assert scans(df) == 1 and "Union" not in plan(df)


def test_plays_with_their_conversions_in_one_pass(spark):
    td = spark.createDataFrame([("a", 1, 40, 6), ("b", 2, None, 6)], "play_uid string, game_id int, yards int, points int")
    out = events.with_conversions(td, ["yards"])
    assert out.columns == td.columns and rows(out) == rows(td.unionByName(events.conversions_of(td, ["yards"]))) and "Union" not in plan(out)


@needs_tables
def test_derived_conversions_read_the_plays_once(spark):
    assert scans(catalog.queries()["e05_derived_conversions"](spark, str(SF))) == 1


def test_copies_of_one_frame_are_compared_from_one_shuffle(spark):
    a = spark.range(2000).selectExpr("id", "id % 7 AS x", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('t', id) END AS y")
    b = a.where("id <> 44").selectExpr("id", "CASE WHEN id = 100 THEN -1 ELSE x END AS x", "CASE WHEN id = 5 THEN '' WHEN id = 6 THEN NULL ELSE y END AS y").unionByName(spark.sql("SELECT 5000L AS id, 1L AS x, 'n' AS y"))
    sides = a.withColumn("side", F.lit("a")).unionByName(b.withColumn("side", F.lit("b")))
    want = rows(compare.differences(a, b, ["id"], ["x", "y"]))
    for tasks in (None, 7):
        assert rows(compare.differences_of(sides, ["id"], ["x", "y"], tasks)) == want and len(want) == 5
    assert rows(compare.differences_of(sides.where("side = 'a'"), ["id"], ["x", "y"])) == sorted([(i, None, "a", None, None) for i in range(2000)], key=repr)


@needs_tables
def test_column_diagnosis_computes_the_kicks_once(spark):
    df = catalog.queries()["v10_column_diagnosis"](spark, str(SF))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1 and "ReusedExchange" in final


def test_the_bridge_of_unique_plays_needs_no_shuffle(spark):
    plays = spark.createDataFrame([("p", 1, 7, 7, 7, None), ("q", 1, None, None, 8, 7), ("r", 2, None, None, None, None)], "uid string, g int, a int, b int, c int, d int")
    roles = (("passer", "a"), ("tackler", "b"), ("tackler", "c"), ("rusher", "d"))
    out = events.bridge(plays, "uid", roles, unique=True)
    assert rows(out) == rows(events.bridge(plays, "uid", roles)) == [("p", "passer", 7, 0), ("p", "tackler", 7, 1), ("q", "rusher", 7, 3), ("q", "tackler", 8, 2)] and "Exchange" not in plan(out)
    carried = events.bridge(plays, "uid", roles, unique=True, carry=["g"]).repartition(3, "g")
    first = events.first_by_role(carried, "uid", ["passer", "rusher"], within=["g"])
    assert first.columns == ["uid", "passer_athlete_id", "rusher_athlete_id"] and rows(first) == [("p", 7, None), ("q", None, 7)] and "hashpartitioning(uid" not in plan(first)
    with pytest.raises(ValueError, match="carried"):
        events.bridge(plays, "uid", roles, carry=["g"])


@needs_tables
@pytest.mark.parametrize("name", ["e13_people_by_role", "e13b_all_roles", "e14_bridge", "q11_play_participants"])
def test_people_of_plays_stay_where_their_play_lies(spark, name):
    assert "hashpartitioning(play_uid" not in plan(catalog.queries()[name](spark, str(SF)))


@needs_tables
@pytest.mark.parametrize("name", ["d07_role_rollup", "d08_links_reach_conversions", "d09_canonical_roles", "d11_modal_role"])
def test_people_are_not_joined_to_their_own_plays(spark, name):
    df = catalog.queries()[name](spark, str(SF))
    assert scans(df) == 1 and "hashpartitioning(play_uid" not in plan(df)
