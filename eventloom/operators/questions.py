"""Many questions over one fact, answered in one pass.

A question names the plays it is about, a subject and a value of a play, and how values become an answer.
Each play is laid out once for every question it belongs to; answers are sums that combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Question:
    """rows, subject and value are SQL expressions over the fact.

    how: `percent` of a flag, `mean`, `sum` or `max` of a number (nulls are in none of them), `distinct` values.
    least: plays a subject needs; top: how many subjects are told, greatest value first, ties by the subject (None: all).
    """

    name: str
    rows: str
    value: str
    how: str
    subject: str = "'all'"
    least: int = 1
    top: int | None = None


_HOW = {"percent": "100.0 * el_sum / nullif(el_known, 0)", "mean": "el_sum / nullif(el_known, 0)", "sum": "coalesce(el_sum, 0.0)", "max": "el_max", "distinct": "cast(el_values as double)"}


def answers(df: DataFrame, asked: Sequence[Question]) -> DataFrame:
    """(question, subject, n, value): n counts the subject's plays.  A null subject is no subject; no plays, no row."""
    if unknown := [(q.name, q.how) for q in asked if q.how not in _HOW]:
        raise ValueError(f"no such way to answer: {unknown}")
    per = []
    for q in asked:
        number, other = ("null", q.value) if q.how == "distinct" else (q.value, "null")
        play = F.struct(F.lit(q.name).alias("question"), F.expr(f"cast({q.subject} as string)").alias("subject"), F.expr(f"cast({number} as double)").alias("v"), F.expr(f"cast({other} as string)").alias("w"))
        per.append(F.when(F.expr(q.rows), play))
    plays = df.select(F.inline(F.filter(F.array(*per), lambda x: x.isNotNull()))).where("subject IS NOT NULL")
    # w is null but for questions of distinct values, so elsewhere the distinct count adds no groups
    sums = plays.groupBy("question", "subject").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("el_sum"), F.count("v").alias("el_known"), F.max("v").alias("el_max"), F.countDistinct("w").alias("el_values"))
    of = lambda each: reduce(lambda c, q: c.when(F.col("question") == q.name, each(q)), asked[1:], F.when(F.col("question") == asked[0].name, each(asked[0])))
    rows = sums.where(F.col("n") >= of(lambda q: F.lit(q.least))).withColumn("value", of(lambda q: F.expr(_HOW[q.how])))
    most = max((q.top for q in asked if q.top is not None), default=None)
    if most is None:
        return rows.select("question", "subject", "n", "value")
    # a question that tells all subjects ranks each alone: one limit then holds for all rows, and tasks keep it before the shuffle
    alone = F.when(~F.col("question").isin([q.name for q in asked if q.top is not None]), F.col("subject"))
    order = Window.partitionBy("question", "el_alone").orderBy(F.desc_nulls_last("value"), "subject")
    ranked = rows.withColumn("el_alone", alone).withColumn("el_at", F.row_number().over(order)).where(F.col("el_at") <= most)
    return ranked.where(F.col("el_at") <= of(lambda q: F.lit(q.top or 1))).select("question", "subject", "n", "value")
