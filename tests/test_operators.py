"""Golden rows for the operators."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from eventloom.functions import clean, texts
from eventloom.operators import dims, events, filters, lenses, load, metrics, quality, wide


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def one(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("3", 3), ("3.0", 3), ("", None), (" ", None), ("x", None), (None, None), ("9007199254740993", 9007199254740993)])
def test_numbers_from_text(spark, text, want):
    assert one(spark, clean.to_int("v"), v=text) == want


def test_other_kinds_from_text(spark):
    assert one(spark, clean.to_bool("v"), v="true") is True and one(spark, clean.to_bool("v"), v="") is None
    assert str(one(spark, clean.to_date("v"), v="2019-03-04T10:00Z")) == "2019-03-04" and one(spark, clean.to_date("v"), v="n/a") is None
    assert one(spark, clean.clock_seconds("v"), v="14:55") == 895 and one(spark, clean.clock_seconds("v"), v="1:00:05") == 3605 and one(spark, clean.clock_seconds("v"), v="x:1") is None
    assert one(spark, clean.seconds_label(F.lit(895)), v="") == "14:55"
    assert one(spark, clean.floor_band(F.lit(38), 5), v="") == 35 and one(spark, clean.floor_band(F.lit(-3), 5), v="") == -5
    assert one(spark, clean.sequence_number("v"), v="t:1:42:pat") == 42 and one(spark, clean.sequence_number("v"), v="t:1") is None


def test_name_votes(spark):
    assert one(spark, clean.name_key("v"), v="Tarik Ab Jr.") == one(spark, clean.name_key("v"), v="T.Ab") == "t ab"
    rows = [(1, "T.Ab")] * 3 + [(1, "Tarik Ab")] * 2 + [(1, "X.Y")] + [(2, "A.B"), (2, "C.D")] + [(3, None)]
    got = {r.p: r for r in dims.name_votes(spark.createDataFrame(rows, "p int, name string"), "p", "name").collect()}
    assert got[1].name == "Tarik Ab" and got[1].confidence == pytest.approx(5 / 6) and got[2].name is None and 3 not in got


def test_modal_ties_take_the_greater_key(spark):
    df = spark.createDataFrame([(1, "rb"), (1, "wr"), (1, "wr"), (1, "rb"), (2, None)], "a int, role string")
    assert values(dims.modal_by_key(df, "a", "role", "role"), "a", "role") == [(1, "wr")]


@pytest.mark.parametrize(("text", "want"), [
    ("Chris Callahan 33 yd FG GOOD", (33, True, "exact")),
    ("field goal attempt from 40 yards nullified by penaltyGOOD", (40, None, "ambiguous")),
    ("D. Dzioban 0 yd FG GOOD", (None, True, "ambiguous")),
    ("A.Player 72 Yd Return of Blocked Field Goal", (None, False, "partial")),
    ("(:06) M.Bryant 59 yard field goal is No Good, Wide Left", (59, False, "exact")),
    ("A.Vinatieri 53 yard field goal is BLOCKED (A.Johnson)", (53, False, "exact")),
    ("kneel down", (None, None, "none")),
])
def test_field_goal_texts(spark, text, want):
    r = one(spark, texts.field_goal("t"), t=text)
    assert (r.distance, r.made, r.confidence) == want


def test_punt_and_kickoff_texts(spark):
    unknown = one(spark, texts.kick_away("t", "punt"), t="Dom Dzioban punt for 36 yds")
    assert unknown.gross == 36 and unknown.net is None and all(unknown[f] is None for f in texts.END_FLAGS) and unknown.confidence == "exact"
    back = one(spark, texts.kick_away("t", "punt"), t="(07:53) #33 C.Brown punt 48 yards to the USU37 #7 K.Davis return 1 yard to the USU38 (#84 N.Elksnis)")
    assert (back.gross, back.return_yds, back.net, back.returned, back.touchback) == (48, 1, 47, True, False)
    trap = one(spark, texts.kick_away("t", "punt"), t="Adoree' Jackson 55 Yd Punt Return (Matt Cummins Kick)")
    assert (trap.gross, trap.return_yds, trap.returned, trap.confidence) == (None, 55, True, "partial")
    kick = one(spark, texts.kick_away("t", "kickoff"), t="M.Bosher kicks 65 yards from ATL 35 to end zone, Touchback.")
    assert (kick.gross, kick.touchback, kick.returned) == (65, True, False)
    onside = one(spark, texts.kick_away("t", "kickoff"), t="C.Parkey kicks onside 3 yards from CLV 35 to CLV 38. RECOVERED by CLV-R.Higgins.")
    assert onside.onside and onside.gross == 3


@pytest.mark.parametrize(("text", "want"), [("K.Davis returns for no gain to the IowSt 19", 0), ("return for a loss of 34 yards", -34), ("X return for 12 yds to the 30", 12), ("X punt for 40 yds", None)])
def test_return_clauses(spark, text, want):
    assert one(spark, texts.return_yards("t"), t=text) == want


@pytest.mark.parametrize(("text", "want"), [
    ("Derrick Henry 37 Yd Run (Adam Griffith Kick)", ("pat", True, "Adam Griffith")),
    ("J.Doe 3 Yd Run (kick failed)", ("pat", False, None)),
    ("TWO-POINT CONVERSION ATTEMPT. K.Allen pass to L.Tunsil is incomplete. ATTEMPT FAILS.", ("two_point", False, None)),
    ("J.Doe 3 Yd Run (shotgun)", (None, None, None)),
])
def test_conversion_texts(spark, text, want):
    assert tuple(one(spark, texts.conversion("t"), t=text)) == want


def test_kick_families_and_names(spark):
    assert one(spark, texts.kick_family("k", "t"), k="Punt", t="") == "punt" and one(spark, texts.kick_family("k", "t"), k="Rush", t="J kicks off") == "kickoff" and one(spark, texts.kick_family("k", "t"), k="Penalty", t="(Punt formation) pass deep") is None and one(spark, texts.kick_family("k", "t"), k="Rush", t="J runs") is None
    assert one(spark, texts.clean_name("n"), n="(09:34) #98 I.Hankins") == "I.Hankins" and one(spark, texts.clean_name("n"), n="N/A") is None


def test_scores_are_repaired(spark):
    df = spark.createDataFrame([(1, i, s, None) for i, s in enumerate([0, 7, 0, 7, 10])], "g int, seq int, home int, away int")
    out = events.repaired_scores(df, ["g"], ["seq"], ["home", "away"]).orderBy("seq")
    assert values(out, "home_fixed", "home_delta", "away_fixed") == [(0, 0, 0), (7, 7, 0), (7, 0, 0), (7, 0, 0), (10, 3, 0)]


def test_uids_after_another_table(spark):
    kicks = spark.createDataFrame([("u", 1), ("u", 2), ("v", 1)], "b string, o int")
    plays = spark.createDataFrame([("u", 1), ("w", 1), ("w", 2)], "b string, o int")
    assert sorted(values(events.unique_uids(kicks, "b", ["o"], "id"), "id")) == [("u",), ("u#2",), ("v",)]
    assert sorted(values(events.unique_uids_after(plays, kicks, "b", ["o"], "id"), "id")) == [("u#3",), ("w",), ("w#2",)]


def test_next_event_of_one_long_entity_takes_seconds(spark):
    n = 200_000
    df = spark.range(n).select(F.lit("g").alias("g"), F.col("id").alias("seq"), (F.col("id") % 5 == 4).alias("answer"))
    began = time.perf_counter()
    out = events.next_event(df, ["g"], ["seq"], ~F.col("answer"), F.col("answer"), F.col("seq"), "next")
    assert out.agg(F.sum("next")).first()[0] == sum(4 * x for x in range(4, n, 5))
    assert time.perf_counter() - began < 30


def test_next_event_is_the_first_by_the_receiving_team(spark):
    rows = [(1, 10, "A", "kick", None), (1, 11, "B", "snap", 5), (1, 12, "A", "snap", 7), (1, 13, "A", "kick", None)]
    df = spark.createDataFrame(rows, "g int, seq int, team string, kind string, yards int")
    out = events.next_event(df, ["g", "team"], ["seq"], F.col("kind") == "kick", F.col("kind") == "snap", F.col("yards"), "start")
    assert {r.seq: r.start for r in out.where("kind = 'kick'").collect()} == {10: 7, 13: None}


def test_first_downs_and_kinds(spark):
    f = lambda changed, gained, to_go: one(spark, events.first_down(F.lit(changed), F.lit(gained).cast("int"), F.lit(to_go).cast("int"), F.lit(False)), v="")
    assert f(True, 20, 10) is False and f(False, 10, 10) is True and f(False, 3, 10) is False and f(False, None, 10) is None
    assert one(spark, events.kind_from_roles(F.lit("outcome"), F.array(F.lit("rusher"), F.lit("passer"))), v="") == "pass"


def test_bands_and_sites(spark):
    df = spark.createDataFrame([(None,), (19,), (20,), (38,), (63,)], "d int")
    assert values(df.select(wide.distance_floor("d").alias("b")), "b") == [(None,), (15,), (20,), (35,), (60,)]
    df = spark.createDataFrame([(True, None), (False, None), (False, True), (False, False)], "neutral_site boolean, h boolean")
    assert values(df.select(lenses.site(F.col("h")).alias("s")), "s") == [("Neutral",), (None,), ("Home",), ("Away",)]


@pytest.fixture(scope="module")
def grid(spark):
    rows = [("a", 1, "regular", 3, "field_goal", 35, True, "Made", "O'Neil_%"), ("b", 2, "regular", 9, "pat", None, None, "Failed", "x"), ("c", 3, "postseason", 1, "punt", 70, False, "Downed", None)]
    return spark.createDataFrame(rows, "play_uid string, season int, season_type string, week int, play_kind string, kick_yds int, venue_indoor boolean, outcome string, team string")


@pytest.mark.parametrize(("chosen", "want"), [
    ({}, "abc"), ({"phases": ["conversion"]}, "b"), ({"seasons": (2, 3)}, "bc"), ({"weeks": (1, 53)}, "ab"), ({"weeks": (1, 54)}, "abc"), ({"weeks": (54, 54)}, "c"), ({"weeks": (5, 54)}, "bc"),
    ({"dist": (0, 50)}, "ab"), ({"dist": (0, 100)}, "abc"), ({"roof": "indoor"}, "a"), ({"roof": "outdoor"}, "c"), ({"outcomes": []}, "abc"), ({"outcomes": ["Made", None]}, "a"), ({"downs": [1]}, "abc"),
])
def test_facets(grid, chosen, want):
    assert "".join(sorted(r.play_uid for r in grid.where(filters.facets(chosen, "st")).collect())) == want


@pytest.mark.parametrize(("model", "want"), [
    ({"kick_yds": {"filterType": "number", "type": "inRange", "filter": 30, "filterTo": 40}}, "a"), ({"kick_yds": {"filterType": "number", "type": "blank"}}, "b"),
    ({"team": {"filterType": "text", "type": "contains", "filter": "_%"}}, "a"), ({"team": {"filterType": "text", "type": "notEqual", "filter": "X"}}, "ac"), ({"team; DROP": {"type": "blank"}}, "abc"),
    ({"season": {"operator": "OR", "conditions": [{"filterType": "number", "type": "equals", "filter": 1}, {"filterType": "number", "type": "greaterThan", "filter": 2}]}}, "ac"),
])
def test_grid_models(grid, model, want):
    assert "".join(sorted(r.play_uid for r in grid.where(filters.grid_filter(grid, model)).collect())) == want


def test_sorting_and_pages(grid):
    order = filters.sort_model(grid, [{"colId": "kick_yds", "sort": "asc"}])
    assert [r.play_uid for r in filters.page(grid, order, 0, 3).collect()] == ["a", "c", "b"]
    assert [r.play_uid for r in filters.page(grid, order, 2, 3).collect()] == ["b"]
    assert filters.clamped(None) == 50 and filters.clamped(0) == 1 and filters.clamped(9999) == 500
    assert values(filters.pairs(grid, [(1, "a"), (9, "b")], ["season", "play_uid"]), "play_uid") == [("a",)]


def test_guards(spark):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    with pytest.raises(load.LoadRefused):
        load.refuse_empty(df.limit(0))
    with pytest.raises(load.LoadRefused):
        load.refuse_orphans(df, df.where("id = 2"), "id")
    with pytest.raises(load.LoadRefused):
        load.refuse_strays(df, "s", "y")
    with pytest.raises(load.LoadRefused):
        load.refuse_gaps(df, df.limit(0), "id")
    assert load.refuse_orphans(load.refuse_empty(df), df, "id").count() == 1


def test_scoped_replacement_and_publication(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *r: spark.createDataFrame(list(r), "league string, season int, v int")
    load.replace_partitions(rows(("a", 1, 1), ("a", 2, 2)), path, ["league", "season"])
    for _ in range(2):
        load.replace_partitions(rows(("a", 2, 9)), path, ["league", "season"])
    assert sorted(values(spark.read.parquet(path), "season", "v")) == [(1, 1), (2, 9)]
    load.publish(spark, rows(("a", 1, 1)), "el_live")
    load.publish(spark, rows(("a", 1, 2)), "el_live")
    assert values(spark.table("el_live"), "v") == [(2,)]
    last = load.publish(spark, rows(("a", 1, 3)), "el_live")
    versions = sorted(t.name for t in spark.catalog.listTables() if t.name.startswith("el_live_v"))
    assert values(spark.table("el_live"), "v") == [(3,)] and len(versions) == 2 and versions[-1] == last and values(spark.table(versions[0]), "v") == [(2,)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, s string")
    assert values(quality.not_unique(df, "id"), "id", "n") == [(1, 2)]
    assert values(quality.nulls_in(df, "id", "s"), "column", "n") == [("s", 1)]
    assert values(quality.not_accepted(df, "s", ["a"]), "value", "n") == [("z", 1)]
    assert quality.unrelated(df, "s", df.where("s = 'a'"), "s").count() == 1
    assert quality.failing(df, F.col("s") == "a").count() == 2
    assert [quality.verdict(n, 0, 4) for n in (0, 3, 5)] == ["pass", "warn", "error"]
    assert quality.difference(df, df).count() == 0 and quality.difference(df, df.limit(0)).count() == 3
    a, b = quality.checksum(df).first(), quality.checksum(df.repartition(3)).first()
    assert a == b != quality.checksum(df.withColumn("s", F.coalesce("s", F.lit("")))).first()
    assert quality.schema_difference(df, df.withColumn("id", F.col("id").cast("long"))) == [("id", "int", "bigint")]
    old = spark.createDataFrame([("2020-01-01 00:00:00",)], "at string").withColumn("at", F.col("at").cast("timestamp"))
    assert quality.stale(old, "at", "2020-02-01 00:00:00", 8).count() == 1 and quality.stale(old, "at", "2020-01-05 00:00:00", 8).count() == 0


def test_rates_pool_counts_and_skip_the_unstated(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, None), (2, None)], "g int, ok boolean")
    got = {r.g: r.p for r in df.groupBy("g").agg(metrics.percent("ok").alias("p")).collect()}
    assert got == {1: 50.0, 2: None}
    assert values(spark.createDataFrame([(3, 0), (3, 2)], "a int, b int").select(metrics.ratio("a", "b").alias("r")), "r") == [(None,), (1.5,)]


def test_rows_without_a_key_are_dealt_out_and_match_nothing(spark):
    """With a dimension that cannot be broadcast the nulls reach many partitions, and no dimension row joins them."""
    from eventloom.operators import wide

    fact = spark.range(4000).selectExpr("concat('u', id) AS uid", "CASE WHEN id % 10 = 0 THEN id % 7 END AS who")
    dim = spark.range(-70000, 7).selectExpr("id AS athlete_id", "concat('n', id) AS known_name")
    joined = wide.with_dimension(fact, dim.hint("merge"), {"who": "athlete_id"}, {"known_name": "name"}, spread="uid")
    got = joined.collect()
    assert len(got) == 4000 and all(r["name"] == (None if r["who"] is None else f"n{r['who']}") for r in got)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(coalesce(who" in plan


def test_orphans_nulls_composite_keys_and_a_hot_key(spark):
    from pyspark.sql import functions as F

    from eventloom.operators import quality

    rows = spark.createDataFrame([(1, 1, "a")] * 50 + [(1, 2, "b"), (None, 1, "a"), (2, None, None), (3, 3, "a,b")], "x int, y int, z string")
    parents = spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "p int, q int")
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    got = {r.check: tuple(r)[1:] for r in quality.orphans(rows, {"pair": (["x", "y"], parents, ["p", "q"]), "name": (["z"], names, ["name"])}).collect()}
    assert got == {"pair": (3, 52, 2, 2), "name": (3, 53, 1, 1)}
    assert quality.orphans(rows.where("false"), {"name": (["z"], names, ["name"])}).count() == 0
    counts = quality.counted(rows, {"one": F.col("x") == 1, "none": F.col("y") > 9, "unknown": F.lit(None).cast("boolean")})
    assert {r.check: r.n for r in counts.collect()} == {"one": 51, "none": 0, "unknown": 0}


def test_play_filters_are_listed_by_fact(spark):
    import pytest

    from eventloom.operators import playquery as pq

    rows = spark.createDataFrame([("a", 1, 1, 2, None, None, 5, True, "50% off"), ("b", 2, 2, 3, 5, None, None, None, "50 off"), ("c", 2, 3, 1, None, 5, None, False, None)], "play_uid string, season int, kicking_team_id int, receiving_team_id int, kicker_athlete_id int, returner_athlete_id int, tackler_athlete_id int, returned boolean, play_text string").selectExpr("*", "1 AS game_id", "season = 2 AS both_top_division")
    kept = lambda **asked: sorted(r.play_uid for r in pq.selected("kicks", rows, **asked).collect())
    assert kept() == ["a", "b", "c"] and kept(season=None) == ["a", "b", "c"]
    assert kept(team_id=1) == ["a", "c"] and kept(athlete_id=5) == ["a", "b", "c"] and kept(athlete_id=6) == []
    assert kept(returned=False) == ["c"] and kept(text_contains="50% OFF") == ["a"]
    assert kept(top_division_only=True) == ["b", "c"] and kept(top_division_only=False) == ["a", "b", "c"]
    assert [r.play_uid for r in pq.newest(rows, 2).collect()] == ["b", "c"]
    for fact, asked in (("kicks", {"down": 3}), ("scrimmage", {"fg_made": True}), ("kicks", {"1=1 OR season": 1}), ("drives", {}), ("kicks", {"play_kind": "rush"})):
        with pytest.raises(ValueError):
            pq.selected(fact, rows, **asked)
    assert {k: len(v) for k, v in pq.FILTERS.items()} == {"kicks": 16, "scrimmage": 17}


def test_careers_floor_before_numbering_and_direction(spark):
    from eventloom.operators import careers as cr

    kicks = []
    for who, season, punts, back in ((1, 1, 3, 1), (2, 2, 1, 0), (2, 3, 4, 4), (2, 5, 4, 1), (3, 2, 4, 2), (3, 3, 4, 2), (3, 9, 9, 0), (None, 2, 5, 0)):
        kicks += [(who, season, "punt", "Returned" if i < back else "Downed") for i in range(punts)]
    st = spark.createDataFrame(kicks, "player_id int, season int, play_kind string, outcome string").selectExpr("*", *[f"CAST(NULL AS INT) AS {c}" for c in ("fg_distance_yds", "punt_net_yds", "punt_gross_yds", "kickoff_yds")], "CAST(NULL AS BOOLEAN) AS onside")
    sums = cr.season_sums(st, "player_id", in_progress=[9])
    rows = cr.job_seasons(sums, "player_id", floors={"punt": 3})
    assert sorted((r.player_id, r.season, r.exp, r.came_back) for r in rows.collect()) == [(2, 3, 1, True), (2, 5, 2, None), (3, 2, 1, True), (3, 3, 2, False)]
    assert cr.job_seasons(sums, "player_id", floors={"punt": 3}, drop_censored=False).where("censored").count() == 1
    step = cr.steps(cr.measured(rows), "player_id").where("metric = 'ret_rate'").first()  # falling is better
    assert (step.players, step.better, step.worse, step.level, step.before, step.after, step.thin) == (2, 1, 0, 1, 0.75, 0.375, True)
    assert cr.steps(cr.measured(rows), "player_id").where("metric = 'net'").count() == 0
    kept = cr.kept_the_job(cr.measured(rows), 1).count()
    assert kept == 0  # nobody leaves after the first year, so each curve ends before it
    assert cr.job_seasons(sums.where("false"), "player_id").count() == 0
