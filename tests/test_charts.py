"""Option lists, series, questions in one pass, and graded answers on small made-up rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.operators import events, grading, series
from eventloom.operators import filters as fl
from eventloom.operators import options as opt
from eventloom.operators.questions import Question, answers

WIDE = """offense_team_id int, offense_team string, offense_conference string, offense_division string, surface string, field_zone string, season int, play_kind string,
yards_gained int, is_penalty boolean, is_turnover boolean, is_touchdown boolean, is_complete boolean, first_down_gained boolean, points_scored int,
passer_athlete_id int, passer_name string, rusher_athlete_id int, rusher_name string, receiver_athlete_id int, receiver_name string"""


@pytest.fixture(scope="module")
def wide(spark):
    row = lambda team, conf, season, kind, yards, **who: (
        team, None if team is None else f"T{team}", conf, "FBS" if team == 1 else None, None, "red zone", season, kind, yards, kind == "penalty", False, False, None, False, 0,
        who.get("p"), who.get("pn"), who.get("r"), who.get("rn"), who.get("c"), who.get("cn"))
    return spark.createDataFrame([
        row(1, "A", 1996, "rush", 4, r=7, rn="Runner"), row(1, "B", 1997, "rush", None, r=7, rn="Runner"), row(2, "A", 1996, "pass", 900, p=8, pn="Thrower", c=7, cn="Runner"),
        row(None, None, 1996, "penalty", 0, p=9), row(3, "B", 1996, "sack", -5, p=8, pn="Thrower"),
    ], WIDE)


def test_lists_hold_each_value_once_and_no_nulls(wide):
    got = {}
    for r in opt.lists(wide, "off").collect():
        got.setdefault(r.facet, []).append(r.value)
    assert {k: sorted(v) for k, v in got.items()} == {
        "team": ["T1", "T2", "T3"], "conference": ["A", "B"], "division": ["FBS"], "outcome": ["Gain", "Penalty", "Sack", "Unclassified"], "zone": ["red zone"]}
    assert opt.lists(wide.limit(0), "off").count() == 0


def test_teams_follow_their_conference_of_the_season_and_picks_are_dropped(wide):
    ids = lambda df: sorted(r.team_id for r in df.collect())
    assert ids(opt.teams(wide, "off")) == [1, 2, 3] == ids(opt.teams(wide, "off", (), (2000, 2001)))  # seasons alone narrow nothing
    assert ids(opt.teams(wide, "off", ["B"], (1996, 1996))) == [3]
    narrowed = opt.teams(wide, "off", ["A"], (1996, 1996))
    assert ids(opt.kept(narrowed, "team_id", [2, 3, 99])) == [2] and ids(opt.kept(narrowed, "team_id", [])) == []
    assert {r.team_id: r.picked for r in opt.marked(narrowed, "team_id", [2, 3]).collect()} == {1: False, 2: True}


def test_people_of_all_roles_above_a_floor(wide):
    got = {r.player_id: r.label for r in opt.people(wide, "off", least=1).collect()}
    assert got == {7: "Runner · 1996-1997 · 3", 8: "Thrower · 1996-1996 · 2"}  # 9 has no name
    assert [r.player_id for r in opt.people(wide, "off", least=3).collect()] == [7]
    assert [r.player_id for r in opt.people(wide, "off", ["sack"], 1).collect()] == [8]


def test_series_leave_out_what_has_no_count(spark):
    kicks = spark.createDataFrame(
        [(1996, "pat", "Converted", None, None, None), (1996, "two_point", "Failed", None, None, None), (1997, "punt", "Unknown", None, None, 40), (1997, "kickoff", "Touchback", None, None, 60), (1997, "kickoff", "Onside", True, None, 12)],
        "season int, play_kind string, outcome string, onside boolean, punt_net_yds int, kick_yds int")
    assert [(r.phase, r.season, r.n, r.value) for r in series.trends(kicks).orderBy("phase").collect()] == [("conversion", 1996, 1, 1.0), ("kickoff", 1997, 2, 0.5)]
    (r,) = series.conversions_by_season(kicks).collect()
    assert (r.kick_rate, r.two_rate, r.kicks, r.twos) == (1.0, 0.0, 1, 1)
    (r,) = series.kickoffs_by_season(kicks).collect()
    assert (r.n, r.touchback_share) == (1, 1.0)
    assert series.trends(kicks.limit(0)).count() == series.mix(kicks.limit(0), ["season"]).count() == 0
    assert {(r.outcome_group) for r in spark.createDataFrame([("Loss",), ("new",), (None,)], "outcome string").select(series.grouped("off").alias("outcome_group")).collect()} == {"No gain or loss", "Unclassified"}


def test_a_page_tells_how_many_rows_all_pages_have(spark):
    rows = spark.range(7).withColumnRenamed("id", "play_uid")
    assert [(r.play_uid, r.total) for r in fl.page_with_total(rows, [F.col("play_uid")], 5, 10).collect()] == [(5, 7), (6, 7)]
    assert fl.page_with_total(rows, [F.col("play_uid")], 20, 30).count() == 0


def test_questions_in_one_pass(spark):
    plays = spark.createDataFrame([("a", 1, True, 1), ("a", 3, None, 1), ("b", 2, False, 2), ("c", None, True, 2), (None, 9, True, 2), ("d", 2, None, 3)], "who string, yards int, good boolean, game int")
    asked = [
        Question("rate", "true", "cast(good as int)", "percent"), Question("unknown", "good IS NULL", "cast(good as int)", "percent"), Question("nobody", "yards > 100", "yards", "sum"),
        Question("far", "true", "yards", "max", "who", top=2), Question("often", "true", "yards", "mean", "who", least=2), Question("games", "true", "game", "distinct"), Question("both", "yards = 2", "1", "sum", "who", top=1),
    ]
    got = sorted((r.question, r.subject, r.n, r.value) for r in answers(plays, asked).collect())
    # b and d tie; the smaller subject is told
    assert got == [("both", "b", 1, 1.0), ("far", "a", 2, 3.0), ("far", "b", 1, 2.0), ("games", "all", 6, 3.0), ("often", "a", 2, 2.0), ("rate", "all", 6, 75.0), ("unknown", "all", 2, None)]
    assert answers(plays.limit(0), asked).count() == 0
    assert [r.value for r in answers(plays, asked[:1]).collect()] == [75.0]
    with pytest.raises(ValueError, match="median"):
        answers(plays, [Question("q", "true", "yards", "median")])


def test_a_question_list_reads_the_fact_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 AS who", "id AS v").write.parquet(f"{tmp_path}/plays")
    asked = [Question("a", "v > 3", "v", "sum", "who", top=2), Question("b", "v < 50", "v", "max", "who", top=3), Question("c", "true", "v", "distinct")]
    df = answers(spark.read.parquet(f"{tmp_path}/plays"), asked)
    assert df.count() == 2 + 3 + 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Scan parquet") <= 1 and "WindowGroupLimit" in plan


def test_grading(spark):
    said = {"q": "It fell by −27.9 points, to 1,234.5; Cade said so.", "none": None}
    answers_ = spark.createDataFrame(list(said.items()), "id string, answer string")
    cases = [
        ("q", "number", 1234.5, None, None, None, None, True), ("q", "number", 1234.0, None, 0.4, None, None, False), ("q", "number", 1234.0, None, 0.5, None, None, True),
        ("q", "number", -27.9, None, 0.0, None, None, True), ("q", "number", 27.9, None, 0.0, None, None, False), ("q", "number", 27.9, None, 0.0, True, None, True), ("q", "number", None, None, 1.0, None, None, False),
        ("q", "range", 1000.0, 1300.0, None, None, None, True), ("q", "range", 0.0, 20.0, None, None, None, False),
        ("q", "text", None, None, None, None, ["CADE", "points"], True), ("q", "text", None, None, None, None, ["Cade", "rose"], False), ("q", "any", None, None, None, None, ["rose", "fell"], True),
        ("q", "none", None, None, None, None, ["rose"], True), ("q", "none", None, None, None, None, ["fell"], False), ("q", "guess", None, None, None, None, ["fell"], False), ("q", "text", None, None, None, None, None, False),
        ("none", "none", None, None, None, None, ["x"], True), ("none", "number", 0.0, None, None, None, None, False), ("lost", "none", None, None, None, None, ["x"], False),
    ]
    checks = spark.createDataFrame([(c[0], i, *c[1:7]) for i, c in enumerate(cases)], grading.CHECK)
    got = {r.seq: r.passed for r in grading.graded(answers_, checks).collect()}
    assert [got[i] for i in range(len(cases))] == [c[7] for c in cases]
    (r,) = grading.scored(grading.graded(answers_, checks).where("id = 'none'")).collect()
    assert (r.checks, r.passes, r.passed) == (2, 1, False)


def test_a_drive_spans_both_facts(spark):
    plays = spark.createDataFrame([
        (1, 1, 1996, 1, "a", "kicks", "kickoff", 5, 6, 35, None, None, None, None, 1, 900), (1, 1, 1996, 2, "b", "scrimmage", "rush", 6, 5, None, 8, False, 0, None, 1, None),
        (1, 1, 1996, 3, "c", "scrimmage", "pass", 6, 5, 70, 500, False, None, None, 1, 800), (1, 1, 1996, 4, "d", "kicks", "punt", 6, 5, None, None, None, None, None, 1, 700),
        (1, 2, 1996, 5, "e", "scrimmage", "pass", 5, 6, 40, 30, True, -6, None, 2, 600), (1, 2, 1996, 6, "f", "kicks", "field_goal", 5, 6, 20, None, None, None, True, 2, 500),
        (2, 1, 1996, 1, "g", "kicks", "kickoff", 5, 6, 35, None, None, None, None, 1, 900), (3, 1, 1996, 1, "h", "kicks", "field_goal", 5, 6, 9, None, None, None, None, None, None),
    ], "game_id int, drive_number int, season int, seq int, play_uid string, fact string, play_kind string, own_team_id int, other_team_id int, yards_to_goal int, yards_gained int, is_turnover boolean, points_scored int, fg_made boolean, period int, clock_secs_period int")
    got = {(r.game_id, r.drive_number): r for r in events.whole_drives(plays).collect()}
    a, b, c, d = got[1, 1], got[1, 2], got[2, 1], got[3, 1]
    assert (a.offense_team_id, a.defense_team_id, a.start_yards_to_goal, a.end_yards_to_goal, a.plays_total, a.plays_scrimmage, a.yards, a.result, a.start_clock_secs, a.end_clock_secs) == (6, 5, 70, 70, 4, 2, 8, "PUNT", 800, 700)
    assert (b.result, b.is_score, b.yards, b.end_yards_to_goal) == ("FG", True, 0, 20)
    assert (c.offense_team_id, c.start_yards_to_goal, c.plays_total, c.result, c.is_score) == (None, None, 1, "OTHER", False)
    assert (d.result, d.is_score, d.start_period) == ("MISSED FG", False, None)  # a negated kick scores nothing
    assert events.whole_drives(plays.limit(0)).count() == 0


def test_scopes_by_the_conference_of_the_season(spark):
    sides = spark.createDataFrame([("P", "FBS", 1998), ("D", "FBS", 1998), ("D", "FBS", 1999), ("O", "FBS", 1999), ("O", "FCS", 1999), (None, "FBS", 1999), (None, None, 1999)], "kicking_conference string, kicking_division string, season int")
    counts = {name: sides.where(test).count() for name, test in fl.scopes("kicking", ["P"], ("D", 1998)).items()}
    assert counts == {"power": 2, "lasting": 1, "others": 1, "top": 5, "all": 7}
