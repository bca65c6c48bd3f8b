"""Kick texts: rules in their order, names, and the fallback between dialects."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import playtext


def read(spark, kind: str, *texts, book: bool = False) -> list:
    df = spark.createDataFrame([(i, t, book) for i, t in enumerate(texts)], "id int, text string, book boolean")
    return [r["kick"] for r in playtext.with_kick(df, "text", kind, book="book").orderBy("id").collect()]


def test_a_text_that_says_nothing_leaves_all_ends_unknown(spark):
    for got in read(spark, "punt", None, "", "Timeout", "A.Foot punt for 40 yds"):
        assert [got[k] for k in playtext.ENDS] == [None] * 5 and got["return_yds"] is None and got["net"] is None


def test_traps_come_before_the_general_rules(spark):
    (got,) = read(spark, "field_goal", "Dee Moss 62 Yd Return of Missed Field Goal Attempt 40 yd FG GOOD")
    assert got["yards"] is None and got["return_yds"] == 62 and got["made"] is False and got["blocked"] is False and got["confidence"] == "partial"


def test_the_other_dialect_is_taken_whole_or_not_at_all(spark):
    story, book = "Al Foot punt for 41 yds, Dee Moss returns for 6 yds", "A.Cole punts 41 yards to DAL 20, Center-R.L. C.Lamb to DAL 31 for 11 yards (T.N)."
    for first in (False, True):
        a, b = read(spark, "punt", story, book, book=first)
        assert (a["kicker"], a["returner"], a["net"], a["confidence"]) == ("Al Foot", "Dee Moss", 35, "exact")
        assert (b["kicker"], b["returner"], b["net"], b["returned"]) == ("A.Cole", "C.Lamb", 30, True)


def test_names_and_clashing_columns(spark):
    df = spark.createDataFrame([("#7 Ben Long N/A punt for 40 yds, downed", 1)], "text string, el_story_which int")
    got = playtext.with_kick(df, "text", "punt").first()
    assert got["kick"]["kicker"] == "Ben Long" and got["kick"]["downed"]


def test_an_impossible_distance_is_no_distance(spark):
    a, b, c = read(spark, "field_goal", "A.B 16 yd FG GOOD", "A.B 17 yd FG GOOD", "A.B 99 yd FG MISSED short")
    assert (a["yards"], a["confidence"]) == (None, "ambiguous") and (b["yards"], b["confidence"]) == (17, "exact") and c["miss_reason"] == "short"
