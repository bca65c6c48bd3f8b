"""Conversions as rows: those a feed gives a row of their own, and those told only by a scoring play.

A conversion belongs to the side that scored it.  Rows of one sequence number share a base uid; kicks keep
the bare one, as stand-alone conversions are numbered behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.events import unique_uids

#: Fixed values of the feed: the types that are a conversion of their own, their kinds, and how a two-point try was made.
STANDALONE = {"Two Point Pass": "two_point", "Two Point Rush": "two_point", "Defensive 2pt Conversion": "defensive_conversion"}
TRIED_BY = {"Two Point Pass": "pass", "Two Point Rush": "rush"}
#: Words of a text that says the try failed.
FAILED = r"fail|no good|intercepted"


def _mapped(column: str | Column, values: dict[str, str]) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[col]


def scored_by() -> Column:
    """The side whose points rose more by the play; null if neither's did."""
    return F.when(F.col("home_points") > F.col("away_points"), F.col("home_team_id")).when(F.col("away_points") > F.col("home_points"), F.col("away_team_id"))


def sided(rows: DataFrame) -> DataFrame:
    """rows with the subject's ids, its side and its lead before the play; the subject is the scorer, or else the side that began.

    Nothing is swapped: where the feed does not say who began, the scorer is set outright.
    """
    return rows.withColumns(_sides(F.coalesce("scorer", "start_team_id")))


def _sides(team: Column) -> dict[str, Column]:
    home = team == F.col("home_team_id")
    lead = F.col("home_before") - F.col("away_before")
    return {
        "kicking_team_id": team,
        "receiving_team_id": F.when(home, F.col("away_team_id")).when(~home, F.col("home_team_id")),
        "is_home_kicking": home,
        "score_diff_kicking": F.when(home, lead).when(~home, -lead),
    }


def _standalone() -> tuple[Column, dict[str, Column]]:
    """Which rows are conversions of their own, and the columns of these."""
    failed = F.coalesce(F.lower("play_text").rlike(FAILED), F.lit(False))
    kind, scorer = _mapped("play_type", STANDALONE), scored_by()
    good = F.coalesce(F.col("scoring"), F.lit(False)) & scorer.isNotNull() & ~failed
    return F.col("play_type").isin(*STANDALONE), {
        "play_kind": kind, **_sides(F.coalesce(scorer, "start_team_id")),
        "converted": F.when(kind == "two_point", good).otherwise(True),
        "two_point_type": _mapped("play_type", TRIED_BY),
        "parse_confidence": F.when(F.length("play_text") > 0, "exact").otherwise("partial"),
        "emit_rank": F.lit(1),
    }


def _told(feed: DataFrame, touchdowns: Sequence[str], nulled: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """Which rows tell of a conversion, and the columns of it."""
    low = F.lower(F.coalesce("play_text", F.lit("")))
    failed = low.rlike(FAILED)
    return F.col("play_type").isin(*touchdowns) & (F.coalesce("scoring", F.lit(False)) | low.contains("kick attempt")), {
        **_sides(F.coalesce(scored_by(), "start_team_id")),
        "base_uid": F.concat("base_uid", F.lit(":pat")), "play_kind": F.when(low.contains("two-point"), "two_point").otherwise("pat"),
        "converted": F.when(failed, False).when(low.contains("good"), True), "two_point_type": F.lit(None).cast("string"),
        "parse_confidence": F.when(failed | low.contains("good"), "exact").otherwise("partial"), "emit_rank": F.lit(0),
        **{c: F.lit(None).cast(feed.schema[c].dataType) for c in nulled},
    }


def standalone(feed: DataFrame) -> DataFrame:
    """The feed's own conversion rows: a try counts if its side scored and its text does not say otherwise."""
    test, columns = _standalone()
    return feed.where(test).withColumns({"scorer": scored_by(), **columns})


def told_by_scores(feed: DataFrame, touchdowns: Sequence[str], nulled: Sequence[str]) -> DataFrame:
    """A conversion for each touchdown that scored or whose text tells of a kick: the play's row, its own measures nulled, its uid marked."""
    test, columns = _told(feed, touchdowns, nulled)
    return feed.where(test).withColumns({"scorer": scored_by(), **columns})


def emitted(kicks: DataFrame, feed: DataFrame, order: Sequence[str], touchdowns: Sequence[str], nulled: Sequence[str]) -> DataFrame:
    """Kicks and all conversions, each with its own play_uid.  kicks has the feed's columns and those of a conversion."""
    rows = kicks.withColumn("emit_rank", F.lit(0))
    for more in (told_by_scores(feed, touchdowns, nulled), standalone(feed)):
        rows = rows.unionByName(more.select(rows.columns))
    return unique_uids(rows, "base_uid", ("emit_rank", *order), "play_uid", within=("game_id",))


def emitted_by(feed: DataFrame, is_kick: Column, kick: dict[str, Column], order: Sequence[str], touchdowns: Sequence[str], nulled: Sequence[str]) -> DataFrame:
    """emitted() where the kicks are rows of the feed: each row emits what it tells of, so the feed is read and sorted once.

    kick: play_kind, converted, two_point_type and parse_confidence of a kick; its subject is the side that began.
    """
    kicks = (is_kick, {**kick, **_sides(F.col("start_team_id")), "emit_rank": F.lit(0)})
    kinds = [kicks, _told(feed, touchdowns, nulled), _standalone()]
    names = list(dict.fromkeys(c for _, columns in kinds for c in columns))
    told = [F.when(test, F.struct(*[columns.get(c, F.col(c) if c in feed.columns else None).alias(c) for c in names])) for test, columns in kinds]
    rows = feed.select(*[c for c in feed.columns if c not in names], F.inline(F.filter(F.array(*told), lambda e: e.isNotNull())))
    return unique_uids(rows, "base_uid", ("emit_rank", *order), "play_uid", within=("game_id",))
