"""Reparse with undo, frames published together, corpora, copies compared, guarded answers, merged streams: the edges."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from eventloom.operators import compare, conversions, corpora, events, load
from eventloom.plans import guard
from eventloom.streaming import live


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


# reparse


def test_reparse_refuses_gaps_and_undo_gives_back_every_value(spark):
    stored = spark.createDataFrame([(1, "a", None, 7), (2, None, 5, 8), (3, "c", 6, 9)], "id int, name string, yards int, other int")
    staged = spark.createDataFrame([(1, None, None), (2, "b", None), (3, "c", 6), (4, "new", 1)], "id int, name string, yards int")
    new, before = load.reparsed(stored, staged, "id", ["name", "yards"])
    assert rows(new) == [(1, None, None, 7), (2, "b", None, 8), (3, "c", 6, 9)] and new.columns == stored.columns
    assert rows(before) == [(1, "a", None), (2, None, 5)]
    assert rows(load.undone(new, before, "id", ["name", "yards"])) == rows(stored)
    with pytest.raises(load.LoadRefused, match="lacks 1"):
        load.reparsed(stored, staged.where("id <> 2"), "id", ["name"])


def test_reparse_of_a_published_table(spark):
    load.publish(spark, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int"), "el_reparse")
    undo = load.reparse(spark, "el_reparse", spark.createDataFrame([(1, "z"), (2, "b")], "id int, name string"), "id", ["name"])
    assert rows(spark.table("el_reparse")) == [(1, "z", 1), (2, "b", 2)]
    load.undo_reparse(spark, "el_reparse", undo, "id")
    assert rows(spark.table("el_reparse")) == [(1, "a", 1), (2, "b", 2)]


def test_upsert_refuses_what_would_touch_a_row_twice(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    for news in ([(1, "b"), (1, "c")], [(None, "b")]):
        with pytest.raises(load.LoadRefused):
            load.upserted(old, spark.createDataFrame(news, "id int, v string"), ["id"])
    assert rows(load.upserted(old, spark.createDataFrame([(1, None), (2, "n")], "id int, v string"), ["id"])) == [(1, "a"), (2, "n")]


# frames that belong together


def test_a_writer_that_dies_between_two_frames_leaves_the_old_pair(spark, tmp_path):
    base = f"file://{tmp_path}/pair"
    fact = lambda *ids: spark.createDataFrame([(i,) for i in ids], "uid int")
    load.publish_together({"fact": fact(1, 2), "bridge": fact(1)}, base)
    broken = fact(3).select(F.raise_error(F.lit("the writer died")).cast("int").alias("uid"))
    with pytest.raises(Exception, match="the writer died"):
        load.publish_together({"fact": fact(3, 4), "bridge": broken}, base)
    shown = load.published(spark, base)
    assert rows(shown["fact"]) == [(1,), (2,)] and rows(shown["bridge"]) == [(1,)]
    load.publish_together({"fact": fact(3, 4), "bridge": fact(3)}, base)
    shown = load.published(spark, base)
    assert rows(shown["fact"]) == [(3,), (4,)] and rows(shown["bridge"]) == [(3,)]


# corpora


def test_corpora_follow_their_games_and_lose_nothing(spark, tmp_path):
    games = spark.createDataFrame([(1, 10, "a"), (2, 11, "b"), (3, 10, "b"), (4, None, "a")], "game_id int, venue_id int, league string")
    plays = spark.createDataFrame([("p1", 1, "a"), ("p2", 2, "b"), ("p3", 3, "b")], "play_uid string, game_id int, league string")
    people = spark.createDataFrame([("p1", 7), ("p1", 8), ("p3", 7)], "play_uid string, athlete_id int")
    venues = spark.createDataFrame([(10, "both"), (11, "b only"), (12, "none")], "venue_id int, name string")
    a, b = (corpora.part(c, games, {"plays": plays}, {"people": (people, "plays")}, {"venues": (venues, "venue_id")}) for c in "ab")
    assert rows(a["venues"]) == [(10, "both")] and rows(b["venues"]) == [(10, "both"), (11, "b only")]
    assert rows(a["people"]) == [("p1", 7), ("p1", 8)] and "league" not in a["plays"].columns
    corpora.refuse_loss(people, [a["people"], b["people"]])
    with pytest.raises(load.LoadRefused, match="lack 1 rows"):
        corpora.refuse_loss(people, [a["people"], b["people"].where("athlete_id <> 7")])
    plays.write.partitionBy("league").parquet(f"file://{tmp_path}/plays")
    assert corpora.attach(spark, f"file://{tmp_path}", ["a", "b"], ["plays"]) == ["a_plays", "b_plays"]
    assert rows(spark.table("b_plays").select("play_uid")) == [("p2",), ("p3",)]
    plan = spark.table("b_plays")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(league" in plan.replace("\n", " ")


# copies


def test_differences_name_columns_and_keys_and_open_only_their_buckets(spark):
    a = spark.range(2000).selectExpr("id", "id % 7 AS x", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('t', id) END AS y")
    b = a.where("id <> 44").selectExpr("id", "CASE WHEN id = 100 THEN -1 ELSE x END AS x", "CASE WHEN id = 5 THEN '' WHEN id = 6 THEN NULL ELSE y END AS y").unionByName(spark.sql("SELECT 5000L AS id, 1L AS x, 'n' AS y"))
    assert rows(compare.differences(a, b, ["id"], ["x", "y"])) == sorted([(44, None, "a", None, None), (100, "x", "both", "2", "-1"), (5, "y", "both", None, ""), (6, "y", "both", "t6", None), (5000, None, "b", None, None)], key=repr)
    assert rows(compare.differences(a, a.repartition(7), ["id"], ["x", "y"])) == []
    sums = [compare.bucket_sums(df, ["id"], ["x", "y"], 64) for df in (a, b)]
    found = {r["bucket"]: r["columns"] for r in compare.differing(*sums, ["x", "y"]).collect()}
    assert 0 < len(found) <= 5
    larger = {r["bucket"] for r in compare.differing(*[compare.merged(s, ["x", "y"], 8) for s in sums], ["x", "y"]).collect()}
    assert larger == {k // 8 for k in found}
    swapped = a.withColumn("x", F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("x")))
    assert len(rows(compare.differences(a, swapped, ["id"], ["x"], 1))) == 2  # values that change places in one bucket


# kinds and conversions


def test_kinds_of_types_named_after_outcomes(spark):
    plays = spark.createDataFrame([(i, k) for i, k in enumerate(["Rush", "Interception", "Fumble", "Fumble", "Safety", "Timeout", None, "Sack", "Pass", ""])], "play_uid int, play_type string")
    people = spark.createDataFrame([(0, "passer"), (1, "passer"), (2, "rusher"), (2, "passer"), (3, "rusher"), (5, "passer"), (9, "tackler")], "play_uid int, role string")
    got = {r["play_uid"]: (r["play_kind"], r["is_complete"]) for r in events.kinds_by_people(plays, people).collect()}
    assert got == {0: ("rush", None), 1: ("pass", False), 2: ("pass", None), 3: ("rush", None), 4: ("other", None), 5: ("other", None), 6: ("other", None), 7: ("sack", None), 8: ("pass", None), 9: ("other", None)}


def test_a_standalone_conversion_belongs_to_its_scorer_and_leaves_kicks_the_bare_uid(spark):
    schema = "base_uid string, game_id int, k int, home_team_id int, away_team_id int, play_type string, play_text string, scoring boolean, home_points int, away_points int, start_team_id int, yards int, home_before int, away_before int"
    feed = spark.createDataFrame([
        ("g:1", 1, 1, 10, 20, "Two Point Pass", "good", True, 2, 0, None, 3, 7, 9), ("g:1", 1, 2, 10, 20, "Kickoff", "kick", False, 0, 0, 20, 4, 7, 9),
        ("g:2", 1, 3, 10, 20, "Two Point Rush", "Conversion FAILED", True, 0, 2, None, 3, 7, 9), ("g:3", 1, 4, 10, 20, "Defensive 2pt Conversion", None, True, 0, 2, 10, 3, 7, 9),
        ("g:4", 1, 5, 10, 20, "Two Point Rush", "", False, 0, 0, None, 3, 7, 9), ("g:5", 1, 6, 10, 20, "Rushing Touchdown", "Kick attempt good", False, 0, 0, 20, 3, 7, 9),
    ], schema)
    kicks = conversions.sided(feed.where("play_type = 'Kickoff'").withColumn("scorer", F.lit(None).cast("int"))).withColumns({"play_kind": F.lit("kickoff"), "converted": F.lit(None).cast("boolean"), "two_point_type": F.lit(None).cast("string"), "parse_confidence": F.lit("exact")})
    got = {r["play_uid"]: r for r in conversions.emitted(kicks, feed, ["k"], ["Rushing Touchdown"], ["yards"]).collect()}
    what = lambda u: tuple(got[u][c] for c in ("play_kind", "converted", "two_point_type", "kicking_team_id", "receiving_team_id", "is_home_kicking", "score_diff_kicking", "parse_confidence"))
    assert what("g:1") == ("kickoff", None, None, 20, 10, False, 2, "exact") and what("g:1#2") == ("two_point", True, "pass", 10, 20, True, -2, "exact")
    assert what("g:2") == ("two_point", False, "rush", 20, 10, False, 2, "exact") and what("g:3") == ("defensive_conversion", True, None, 20, 10, False, 2, "partial")
    assert what("g:4") == ("two_point", False, "rush", None, None, None, None, "partial")
    assert what("g:5:pat")[:2] == ("pat", True) and got["g:5:pat"]["yards"] is None and got["g:1"]["yards"] == 4


# guarded answers


@pytest.fixture(scope="module")
def plays(spark):
    spark.range(10).selectExpr("id", "id % 2 AS x").createOrReplaceTempView("el_plays")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION el_leak() RETURNS BIGINT RETURN SELECT count(*) FROM el_plays")
    return ["el_plays"]


@pytest.mark.parametrize("sql", ["SELECT el_leak()", "SELECT el_leak() FROM el_plays", "SELECT current_user FROM el_plays", "SELECT user FROM el_plays", "SELECT session_user", "SELECT current_database()", "SELECT current_catalog", "SELECT spark_catalog.default.f(1)", "SELECT * FROM el_plays LIMIT length('a' || id)"])
def test_functions_of_the_session_are_refused(spark, plays, sql):
    with pytest.raises(guard.Refused):
        guard.check(spark, sql, plays)


def test_own_limits_are_seen_wherever_they_stand(spark, plays):
    assert guard.check(spark, "SELECT upper('a'), count(*) FROM el_plays LATERAL VIEW explode(array(1)) t LIMIT 1 + 1", plays).limit == 2
    report = guard.check(spark, "WITH a AS (SELECT * FROM el_plays) SELECT * FROM a LIMIT 5", plays)
    assert (report.limit, report.limit_source) == (5, "statement")


def test_answers_keep_repeated_names_and_say_what_is_cut(spark, plays):
    got = guard.answer(spark, "SELECT id AS a, x AS a FROM el_plays ORDER BY id", plays, limit=3)
    assert got["columns"] == ["a", "a"] and got["rows"] == [[0, 0], [1, 1], [2, 0]] and got["row_count"] == 3 and got["truncated"] and got["tables"] == plays
    assert not guard.answer(spark, "SELECT id FROM el_plays", plays)["truncated"]
    told = guard.answer(spark, "SELECT id FROM el_plays", plays, explain_only=True)
    assert told["explain_only"] and any("Project" in r[0] or "Range" in r[0] for r in told["rows"])


def test_a_statement_that_runs_too_long_is_cancelled_and_the_session_lives_on(spark, plays):
    spark.range(10**12).createOrReplaceTempView("el_slow")
    slow = "SELECT count(*) FROM el_slow WHERE sha2(CAST(id AS STRING), 256) = 'x'"
    began = time.time()
    with pytest.raises(guard.TimedOut):
        guard.answer(spark, slow, [*plays, "el_slow"], seconds=2)
    assert time.time() - began < 60
    assert guard.answer(spark, "SELECT count(*) FROM el_plays", plays)["rows"] == [[10]]


# merged streams


@pytest.mark.parametrize(("kind", "old", "new"), [("string", "10:30", "11:30"), ("string", "a/b", "c/d"), ("timestamp", "2024-01-01 10:30:00", "2024-01-02 11:00:00"), ("string", "plain", None), ("string", "50%", "x=y")])
def test_a_key_that_moves_leaves_its_old_partition_whatever_its_name(spark, tmp_path, kind, old, new):
    path = f"file://{tmp_path}/m"
    merge = live.merge_into(path, "id", "at", "part")
    row = lambda at, part: spark.createDataFrame([(1, at, part)], "id int, at int, part string").withColumn("part", F.col("part").cast(kind))
    merge(row(1, old), 0)
    merge(row(2, new), 1)
    got = spark.read.parquet(path).collect()
    assert [(r["id"], r["at"]) for r in got] == [(1, 2)]


# feeds


def test_a_team_listed_twice_belongs_where_it_is_listed_last(spark):
    from eventloom.operators import dims

    tree = '{"groups":[{"id":1,"name":"A","children":[{"name":"x","teams":[{"id":7},{"id":8},{}]}]},{"id":2,"name":"B","children":null},{"id":3,"name":"C","children":[{"name":"y","teams":[{"id":8}]},{"name":"z","teams":[{"id":8}]}]}]}'
    df = spark.createDataFrame([(2020, tree), (2021, "{}"), (2022, "not json"), (2023, None)], "season int, tree string")
    assert rows(dims.last_group(df)) == [(2020, 7, 1, "A", "x"), (2020, 8, 3, "C", "z")]


def test_games_without_teams_or_venue_are_rows_still(spark):
    from eventloom.operators import dims

    games = ['{"id":1,"season":2020,"season_type":3,"teams":[{"id":5,"home_away":"away"},{"id":4,"home_away":"home"}],"venue":{"id":9}}', '{"id":2,"season_type":1,"teams":[]}', '{"id":3}', "{}", None]
    got = {r["game_id"]: r for r in dims.game_rows(spark.createDataFrame([(g,) for g in games], "game string")).collect()}
    assert (got[1]["home_team_id"], got[1]["away_team_id"], got[1]["venue_id"], got[1]["season_type"]) == (4, 5, 9, "postseason")
    assert set(got) == {1, 2, 3} and got[2]["season_type"] == "regular" and got[2]["home_team_id"] is None and got[3]["venue_id"] is None


def test_careers_count_a_play_once_whatever_the_roles(spark):
    from eventloom.operators import dims

    plays = spark.createDataFrame([(2000, 1, 1, None), (2001, 1, 2, 1), (2002, None, 2, 2)], "season int, a int, b int, c int")
    entries = events.entries(plays, (("passer", "a"), ("rusher", "b"), ("tackler", "c")), ["season"])
    assert rows(dims.careers_of(entries)) == [(1, 2000, 2001, 2, "passer"), (2, 2001, 2002, 2, "rusher")]
