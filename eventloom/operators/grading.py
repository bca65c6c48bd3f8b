"""Answers in words against what they should say, as Columns over tables of answers and checks.

A check is a row with the id of its answer, a kind and what that kind needs:

* `number`: some number of the answer is within `tol` (null: 0) of `low`; with `signless`, its size is.
* `range`: some number of the answer lies from `low` to `high`.
* `text`, `any`, `none`: all, one or none of `words` are in the answer, whatever their case.

Numbers may have a sign (a hyphen or U+2212), commas and decimals.  A null answer is an empty one.  A check
with a null where its kind needs a value, or with another kind, is not passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import metrics as m

#: For sums of doubles at the edge of a tolerance.
SLACK = 1e-9
CHECK = "id string, seq int, kind string, low double, high double, tol double, signless boolean, words array<string>"


def numbers(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit("[-−]?[0-9][0-9,]*(?:\\.[0-9]+)?"), F.lit(0))
    return F.transform(found, lambda x: F.replace(F.replace(x, F.lit("−"), F.lit("-")), F.lit(",")).cast("double"))


def passed(answer: str = "answer") -> Column:
    text = F.coalesce(F.col(answer), F.lit(""))
    near = F.coalesce("tol", F.lit(0.0)) + SLACK
    has = lambda w: F.lower(text).contains(F.lower(w))
    close = lambda x: (F.abs(x - F.col("low")) <= near) | (F.coalesce("signless", F.lit(False)) & (F.abs(F.abs(x) - F.abs("low")) <= near))
    held = (
        F.when(F.col("kind") == "number", F.exists(numbers(text), close)).when(F.col("kind") == "range", F.exists(numbers(text), lambda x: x.between(F.col("low"), F.col("high"))))
        .when(F.col("kind") == "text", F.forall("words", has)).when(F.col("kind") == "any", F.exists("words", has)).when(F.col("kind") == "none", ~F.exists("words", has))
    )
    return F.coalesce(held, F.lit(False))


def graded(answers: DataFrame, checks: DataFrame, on: str = "id", answer: str = "answer") -> DataFrame:
    """The checks, each with whether its answer passes; without an answer none does, not even one for words that must be absent."""
    said = answers.select(on, F.col(answer).alias("el_answer"), F.lit(True).alias("el_given"))
    rows = checks.join(said, on, "left").withColumn("passed", F.coalesce("el_given", F.lit(False)) & passed("el_answer"))
    return rows.drop("el_answer", "el_given")


def scored(checks: DataFrame, on: str = "id") -> DataFrame:
    """(id, checks, passes, passed): an answer passes when all of its checks do."""
    return checks.groupBy(on).agg(m.n().alias("checks"), m.n(F.col("passed")).alias("passes"), F.bool_and("passed").alias("passed"))
