"""Feeds, the SQL entry point, and streams."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from eventloom.plans import guard
from eventloom.sources import feeds
from eventloom.streaming import live


def play(seq, text, home=0, team="1", ytg=50):
    return {"sequenceNumber": str(seq), "type": {"id": "1", "text": "Rush"}, "text": text, "period": {"number": 1}, "clock": {"displayValue": "14:55"}, "homeScore": home, "awayScore": 0, "statYardage": 4,
            "start": {"down": 1, "distance": 10, "yardsToEndzone": ytg, "team": {"id": team}}, "teamParticipants": [{"id": "2", "type": "defense"}]}


def test_game_documents(spark, tmp_path):
    good = {"game_id": "7", "drives": [{"id": "d1", "result": "TD", "plays": [play(1, "a"), play(2, "b", 7, ytg=0)]}, {"id": "d2", "plays": []}]}
    with gzip.open(tmp_path / "7.json.gz", "wt") as f:
        json.dump(good, f)
    (tmp_path / "8.json").write_text("{broken")
    games = feeds.read_games(spark, f"file://{tmp_path}")
    assert sum(r._corrupt is not None for r in games.select("game_id", "_corrupt").collect()) == 1
    rows = feeds.plays_of(games).orderBy("play_no").collect()
    assert [(r.base_uid, r.play_text, r.home_score, r.offense_team_id, r.defense_team_id, r.yards_to_goal) for r in rows] == [("t:7:1", "a", 0, "1", "2", 50), ("t:7:2", "b", 7, "1", "2", None)]


def test_participants_of_both_key_shapes(spark):
    df = spark.createDataFrame([("7", {"12": [["passer", "5"], ["receiver", "x"]], "7:13": [["rusher", "6"]]})], "game_id string, participants map<string,array<array<string>>>")
    got = sorted((r.sequence, r.role, r.athlete_id, r.ordinal) for r in feeds.participants_of(df).collect())
    assert got == [("12", "passer", 5, 0), ("12", "receiver", None, 1), ("13", "rusher", 6, 0)]


def test_staging_extracts_and_exports(spark, tmp_path):
    (tmp_path / "a.csv").write_text('uid,note\n1,"line\none"\n2,\n')
    (tmp_path / "b.csv").write_text("note,uid,more\nx,1,y\n")
    staged = feeds.read_staging(spark, f"file://{tmp_path}/a.csv", ["uid", "note"])
    assert sorted((r.uid, r.note) for r in staged.collect()) == [("1", "line\none"), ("2", None)]
    both = feeds.read_extracts(spark, [f"file://{tmp_path}/b.csv", f"file://{tmp_path}/b.csv"])
    assert sorted(r._ord for r in both.collect()) == [0, 1]
    with pytest.raises(FileNotFoundError):
        feeds.read_extracts(spark, [])
    told = feeds.export(spark.range(10), f"file://{tmp_path}/out", cap=4)
    assert told["truncated"] and told["total"] == 10 and spark.read.option("header", True).csv(told["path"]).count() == 4
    feeds.snapshot({"t": spark.range(3)}, f"file://{tmp_path}/snap", "test", "2020-01-01 00:00:00")
    assert spark.read.parquet(f"file://{tmp_path}/snap/snapshot_meta").first().source == "test"


ALLOWED = ("plays", "games")


@pytest.mark.parametrize("sql", [
    "", "  ", "SELEC 1", "SELECT 1; SELECT 2", "DROP TABLE plays", "INSERT INTO plays SELECT * FROM games", "CREATE TABLE x AS SELECT 1", "CREATE VIEW x AS SELECT 1", "DELETE FROM plays", "UPDATE plays SET a = 1", "SET a = 1",
    "ALTER TABLE plays RENAME TO x", "TRUNCATE TABLE plays", "CACHE TABLE plays", "USE other", "SHOW TABLES", "DESCRIBE plays", "EXPLAIN SELECT 1", "SELECT * FROM secrets", "SELECT * FROM other.plays", "SELECT * FROM a.b.plays",
    "SELECT java_method('java.lang.System', 'exit')", "SELECT reflect('a', 'b')", "SELECT * FROM plays WHERE x IN (SELECT id FROM secrets)", "SELECT (SELECT max(id) FROM secrets)", "WITH t AS (SELECT * FROM secrets) SELECT * FROM t",
    "WITH t AS (SELECT 1) SELECT * FROM other.t", "WITH plays AS (SELECT 1) SELECT * FROM plays, secrets", "SELECT * FROM range(5)", "SELECT * FROM plays JOIN LATERAL (SELECT * FROM secrets)", "SELECT current_user()", "SELECT * FROM parquet.`/etc`",
    "SELECT * FROM IDENTIFIER('secrets')", "SELECT IDENTIFIER('java_method')('a', 'b')", "SELECT * FROM plays WHERE id IN (SELECT id FROM IDENTIFIER('sec' || 'rets'))",
    "SELECT * FROM secrets WHERE EXISTS (WITH secrets AS (SELECT 1) SELECT * FROM secrets)", "SELECT * FROM plays WHERE EXISTS (WITH t AS (SELECT 1) SELECT * FROM t) AND id IN (SELECT id FROM t)",
    "WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a", "WITH secrets AS (SELECT * FROM secrets) SELECT * FROM secrets", "(WITH t AS (SELECT 1) SELECT * FROM t) UNION ALL SELECT * FROM t", "TABLE secrets", "FROM secrets SELECT *",
    "SELECT TRANSFORM(id) USING 'cat' FROM plays",
])
def test_guard_refuses(spark, sql):
    with pytest.raises(guard.Refused):
        guard.check(spark, sql, ALLOWED, "own")


@pytest.mark.parametrize(("sql", "tables"), [
    ("SELECT * FROM plays", ["plays"]), ("select count(*) from own.plays p join games g on p.id = g.id", ["games", "plays"]), ("WITH t AS (SELECT * FROM plays) SELECT * FROM t", ["plays"]),
    ("WITH a AS (SELECT * FROM plays), b AS (SELECT * FROM a) SELECT * FROM b", ["plays"]), ("SELECT season, count(*) FROM plays GROUP BY season HAVING count(*) > 1 ORDER BY 2 LIMIT 5", ["plays"]),
    ("SELECT * FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY id) AS r FROM plays) WHERE r = 1", ["plays"]), ("SELECT * FROM (VALUES (1)) AS v(x)", []), ("SELECT DISTINCT id FROM plays EXCEPT SELECT id FROM games", ["games", "plays"]),
    ("WITH games AS (SELECT * FROM plays) SELECT * FROM games", ["plays"]), ("SELECT sum(id) OVER w FROM plays WINDOW w AS (ORDER BY id)", ["plays"]), ("SELECT id FROM plays LATERAL VIEW explode(array(1, 2)) AS x", ["plays"]),
    ("SELECT * FROM plays UNION ALL SELECT * FROM games", ["games", "plays"]), ("SELECT 'DROP TABLE plays; --' AS s", []), ("SELECT * FROM plays WHERE id IN (SELECT id FROM games)", ["games", "plays"]),
])
def test_guard_accepts(spark, sql, tables):
    assert guard.check(spark, sql, ALLOWED, "own").tables == tables


def test_guarded_rows_are_limited(spark):
    spark.range(5000).createOrReplaceTempView("plays")
    for limit, rows, source in ((None, 200, "default"), (10, 10, "caller"), (99_999, 2000, "capped")):
        df, report = guard.run(spark, "SELECT * FROM plays ORDER BY id", ALLOWED, limit=limit)
        assert df.count() == rows == report.limit and report.limit_source == source and report.truncated
    for sql, limit, rows, source, truncated in (("SELECT * FROM plays LIMIT 7", None, 7, "statement", False), ("SELECT * FROM plays LIMIT 3000", None, 2000, "capped", True), ("SELECT * FROM plays LIMIT 7", 5, 5, "caller", True), ("SELECT * FROM plays WHERE id < 3", None, 3, "default", False)):
        df, report = guard.run(spark, sql, ALLOWED, limit=limit)
        assert (df.count(), report.limit_source, report.truncated) == (rows, source, truncated), sql
    assert "plays" in guard.policy(ALLOWED)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_running_scores_keep_state_over_batches(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    for i, rows in enumerate([[("g", 1, 0, 0), ("g", 2, 7, 0), ("h", 1, 3, 0)], [("g", 3, 0, 3), ("g", 4, 10, None), ("h", 2, 2, 6)]]):
        spark.createDataFrame(rows, "game string, seq bigint, home int, away int").coalesce(1).write.mode("append" if i else "overwrite").parquet(path)
    q = live.running_scores(stream_of(spark, path, "game string, seq bigint, home int, away int")).writeStream.format("memory").queryName("el_scores").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("el_scores").collect()) == [("g", 1, 0, 0), ("g", 2, 7, 0), ("g", 3, 7, 3), ("g", 4, 10, 3), ("h", 1, 3, 0), ("h", 2, 3, 6)]


def test_merged_batches_take_the_newest_row(spark, tmp_path):
    merge = live.merge_into(f"file://{tmp_path}/m", "id", "at", "season")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, at int, v string, season int")
    for batch in (rows((1, 1, "a", 1), (2, 1, "b", 2)), rows((1, 3, "new", 1), (3, 1, "c", 1)), rows((1, 2, "late", 1)), rows((1, 2, "late", 1))):
        merge(batch, 0)
    assert sorted((r.id, r.v, r.season) for r in spark.read.parquet(f"file://{tmp_path}/m").collect()) == [(1, "new", 1), (2, "b", 2), (3, "c", 1)]


def test_merge_loses_no_stored_row(spark, tmp_path):
    """More or fewer columns in a batch, keys that move to another partition, ties, null partitions, errors that are no absence."""
    path = f"file://{tmp_path}/m"
    merge = live.merge_into(path, "id", "at", "season")
    df = lambda schema, *r: spark.createDataFrame(list(r), schema)
    plain = "id int, at int, v string, season int"
    merge(df(plain, (1, 1, "a", 1), (2, 1, "b", 1), (3, 1, "c", 2), (5, 1, "e", None)), 0)
    merge(df(f"{plain}, w int", (2, 2, "B", 1, 9)), 1)
    got = lambda: sorted((r.id, r.v, r.season) for r in spark.read.option("mergeSchema", "true").parquet(path).collect())
    assert got() == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (5, "e", None)]
    merge(df(plain, (3, 2, "C", 1), (4, 1, "x", 1), (4, 1, "y", 1)), 2)  # 3 leaves season 2, which is empty then
    assert got() == [(1, "a", 1), (2, "B", 1), (3, "C", 1), (4, "y", 1), (5, "e", None)]
    assert [r.w for r in spark.read.option("mergeSchema", "true").parquet(path).where("id = 2").collect()] == [9]
    with pytest.raises(Exception):
        merge(df("id int, at int, v string", (1, 9, "z")), 3)
    assert got() == [(1, "a", 1), (2, "B", 1), (3, "C", 1), (4, "y", 1), (5, "e", None)]


def test_late_rows_within_the_watermark_are_counted(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    spark.createDataFrame([("2024-01-02 00:00:00", "x", 1), ("2024-01-01 00:00:00", "x", 2), ("2024-01-01 00:00:00", "x", 2), ("2024-03-01 00:00:00", "y", 3)], "at string, kind string, id int").select(F.col("at").cast("timestamp").alias("at"), "kind", "id").coalesce(1).write.parquet(path)
    df = stream_of(spark, path, "at timestamp, kind string, id int")
    q = live.counted(df, "at", "kind", key="id").writeStream.format("memory").queryName("el_counts").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((str(r.start)[:10], r.kind, r.n) for r in spark.table("el_counts").collect()) == [("2024-01-01", "x", 1), ("2024-01-02", "x", 1)]


def test_inventory_and_records(spark):
    from eventloom.sources import inventory

    df = spark.range(2).select("id", F.lit(float("nan")).alias("fg_pct"), F.lit("2020-01-02").cast("date").alias("day"), F.lit(3).cast("decimal(10,2)").alias("d"))
    assert inventory.records(df)[0] == {"id": 0, "fg_pct": None, "day": "2020-01-02", "d": 3}
    assert inventory.columns_of({"t": df}, {"t": ("id",)})[0] == {"table": "t", "column": "id", "type": "bigint", "key": True}
    assert inventory.label("fg_pct") == "FG pct" and inventory.number_format("fg_pct").format(1.0) == "1.0%" and inventory.named_like(df, "PCT") == ["fg_pct"]
    assert [inventory.chart_shape(c, n) for c, n in (([("season", "int"), ("n", "bigint")], 5), ([("team", "string"), ("n", "bigint")], 5), ([("team", "string")], 5), ([("n", "int")], 1))] == ["trend", "ranking", "none", "none"]


def test_asked_filters_outside_the_list_are_refused(spark):
    from eventloom.plans.panels import allowed_rows

    df = spark.createDataFrame([(1, 2)], "season int, week int")
    assert allowed_rows(df, {"season": 1, "week": None}).count() == 1
    with pytest.raises(ValueError):
        allowed_rows(df, {"season; DROP": 1})
