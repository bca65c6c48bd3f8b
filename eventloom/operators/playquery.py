"""Rows of either fact for what a caller names: only listed filters, values bound as literals, a bounded page."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import filters as fl

Test = Callable[[Any], Column]


def _is(column: str) -> Test:
    return lambda v: F.col(column) == F.lit(v)


def _at_least(column: str) -> Test:
    return lambda v: F.col(column) >= F.lit(v)


def _at_most(column: str) -> Test:
    return lambda v: F.col(column) <= F.lit(v)


def _any_of(*columns: str) -> Test:
    return lambda v: fl.either(v, *columns)


def _where_set(column: str) -> Test:
    """A switch: false is the same as not asked."""
    return lambda v: F.col(column) if v else F.lit(True)


def _holds(column: str) -> Test:
    return lambda v: fl.matching(column, v)


_BOTH: dict[str, Test] = {
    **{c: _is(c) for c in ("season", "week", "season_type", "play_kind", "game_id", "venue_id", "is_clutch")},
    "top_division_only": _where_set("both_top_division"), "text_contains": _holds("play_text"),
}
#: Filters by fact.  A team or a person matches on either side; a tri-state flag matches what was stated.
FILTERS: dict[str, dict[str, Test]] = {
    "kicks": _BOTH | {c: _is(c) for c in ("fg_made", "touchback", "returned")} | {
        "min_fg_distance": _at_least("fg_distance_yds"), "max_fg_distance": _at_most("fg_distance_yds"),
        "team_id": _any_of("kicking_team_id", "receiving_team_id"), "athlete_id": _any_of("kicker_athlete_id", "returner_athlete_id", "tackler_athlete_id"),
    },
    "scrimmage": _BOTH | {c: _is(c) for c in ("down", "is_touchdown", "is_turnover", "first_down_gained")} | {
        "min_yards": _at_least("yards_gained"), "max_yards": _at_most("yards_gained"), "team_id": _any_of("offense_team_id", "defense_team_id"),
        "athlete_id": _any_of("passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id", "tackler_athlete_id"),
    },
}
#: Filters that take one of a list of values.
CHOICES = {
    "season_type": {"kicks": ("regular", "postseason"), "scrimmage": ("regular", "postseason")},
    "play_kind": {"kicks": ("kickoff", "punt", "field_goal", "pat", "two_point", "defensive_conversion"), "scrimmage": ("rush", "pass", "sack", "penalty", "other")},
}


def selected(fact: str, rows: DataFrame, **asked: Any) -> DataFrame:
    """The rows of a fact that all filters with a value keep.

    A filter of the other fact, an unknown name, a fact or a value that is not on its list is a ValueError; None
    asks nothing.  Filters on columns of the scan are pushed down to it.
    """
    if fact not in FILTERS:
        raise ValueError(f"no such fact: {fact}")
    asked = {k: v for k, v in asked.items() if v is not None}
    if strange := sorted(set(asked) - set(FILTERS[fact])):
        raise ValueError(f"no such filter on {fact}: {', '.join(strange)}")
    for name, value in asked.items():
        if name in CHOICES and value not in CHOICES[name][fact]:
            raise ValueError(f"{name} is one of {', '.join(CHOICES[name][fact])}")
    return rows.where(fl.all_of(FILTERS[fact][name](value) for name, value in asked.items()))


def newest(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """The newest rows up to a clamped limit: a top-k, so no sort of all rows."""
    return rows.orderBy(F.desc("season"), "game_id", "play_uid").limit(fl.clamped(limit))
