"""Filters from data: sidebar facets, grid filter models and sort models as Columns.

Nothing is ever put into SQL text; a name that is no column of the frame is refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRUE = F.lit  # a filter that does nothing is lit(True)

#: Chips that stand for several kinds.
KINDS = {"conversion": ("pat", "two_point", "defensive_conversion")}
#: Columns a player is looked for in, by lens.
PLAYER_COLUMNS = {"st": ("player_id",), "off": ("passer_athlete_id", "rusher_athlete_id", "receiver_athlete_id"), "def": ("tackler_athlete_id",)}
#: Facets that are lists of values of one column.
LISTS = {
    "teams": "team_id", "opponents": "opp_id", "conferences": "conference", "outcomes": "outcome", "season_types": "season_type",
    "surfaces": "surface", "qtrs": "qtr", "score_states": "score_state", "downs": "down", "zones": "field_zone",
}
#: Three-state facets: the column, and the words for its true and its false.
SWITCHES = {"neutral": ("neutral_site", "only", "exclude"), "conf_game": ("conference_game", "only", "exclude"), "roof": ("venue_indoor", "indoor", "outdoor")}


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def among(column: str, values: Sequence | None) -> Column:
    """No values: nothing to narrow."""
    kept = [v for v in values or () if v not in (None, "")]
    return F.col(column).isin(kept) if kept else F.lit(True)


def weeks(span: tuple[int, int], last_regular: int) -> Column:
    """Regular weeks of a span; the mark after the last one stands for the whole postseason."""
    low, high = span
    if low <= 1 and high > last_regular:
        return F.lit(True)
    parts = []
    if low <= last_regular:
        parts.append((F.col("season_type") == "regular") & F.col("week").between(low, min(high, last_regular)))
    if high > last_regular:
        parts.append(F.col("season_type") == "postseason")
    return any_of(parts)


def span_or_null(column: str, low: int, high: int, bounds: tuple[int, int]) -> Column:
    """Rows without a value stay; the full span narrows nothing, whatever lies outside it."""
    if low <= bounds[0] and high >= bounds[1]:
        return F.lit(True)
    return F.col(column).isNull() | F.col(column).between(low, high)


def facets(chosen: dict[str, Any], lens: str = "st", ignore: Sequence[str] = (), last_regular_week: int = 53, dist_bounds: tuple[int, int] = (0, 100)) -> Column:
    """One Column for the chosen facets of a lens; ignore drops facets (a chart of what is filtered on)."""
    f = {k: v for k, v in chosen.items() if k not in ignore and v not in (None, "", [], ())}
    tests = []
    if "phases" in f:
        tests.append(F.col("play_kind").isin([k for chip in f["phases"] for k in KINDS.get(chip, (chip,))]))
    if "seasons" in f:
        tests.append(F.col("season").between(*f["seasons"]))
    if "weeks" in f:
        tests.append(weeks(tuple(f["weeks"]), last_regular_week))
    if "players" in f:
        tests.append(any_of(F.col(c).isin(list(f["players"])) for c in PLAYER_COLUMNS[lens]))
    scrimmage_only = {"downs", "zones"}
    tests += [among(c, f[k]) for k, c in LISTS.items() if k in f and not (k in scrimmage_only and lens == "st")]
    if "dist" in f and lens == "st":
        tests.append(span_or_null("kick_yds", *f["dist"], dist_bounds))
    for k, (column, yes, no) in SWITCHES.items():
        if f.get(k) == yes:
            tests.append(F.col(column))
        elif f.get(k) == no:  # an unknown value leaves the selection too
            tests.append(F.col(column).eqNullSafe(F.lit(False)))
    tests += [F.col(c) for k, c in (("clutch_only", "is_clutch"), ("fbs_only", "both_top_division")) if f.get(k)]
    if f.get("linked_only"):
        tests.append(F.col("player_id").isNotNull())
    return all_of(tests)


_COMPARE = {
    "equals": lambda c, v: c == v, "notEqual": lambda c, v: c != v, "greaterThan": lambda c, v: c > v,
    "greaterThanOrEqual": lambda c, v: c >= v, "lessThan": lambda c, v: c < v, "lessThanOrEqual": lambda c, v: c <= v,
}
_TEXT = {
    "contains": lambda c, v: c.contains(v), "notContains": lambda c, v: ~c.contains(v), "equals": lambda c, v: c == v,
    "startsWith": lambda c, v: c.startswith(v), "endsWith": lambda c, v: c.endswith(v),
}


def condition(column: str, spec: dict[str, Any]) -> Column | None:
    """One condition of a grid's column filter; None where it is not complete."""
    c, test = F.col(column), spec.get("type")
    if test == "blank":
        return c.isNull()
    if test == "notBlank":
        return c.isNotNull()
    kind = spec.get("filterType")
    if kind in ("number", "date"):
        low, high = (spec.get("filter"), spec.get("filterTo")) if kind == "number" else (spec.get("dateFrom"), spec.get("dateTo"))
        value = (lambda v: F.lit(float(v))) if kind == "number" else (lambda v: F.to_date(F.lit(str(v)[:10])))
        if test == "inRange" and low not in (None, "") and high not in (None, ""):
            return c.between(value(low), value(high))
        return _COMPARE[test](c, value(low)) if test in _COMPARE and low not in (None, "") else None
    text = spec.get("filter")
    if text in (None, ""):
        return None
    low = F.lower(c.cast("string"))
    if test == "notEqual":
        return (low != str(text).lower()) | c.isNull()
    return _TEXT[test](low, F.lit(str(text).lower())) if test in _TEXT else None


def grid_filter(df: DataFrame, model: dict[str, dict] | None) -> Column:
    """A grid's filter model: conditions of a column joined by its operator, columns by AND."""
    tests = []
    for column, spec in (model or {}).items():
        if column not in df.columns:
            continue
        built = [t for s in spec.get("conditions") or [spec] if (t := condition(column, s)) is not None]
        if built:
            tests.append(any_of(built) if spec.get("operator") == "OR" else all_of(built))
    return all_of(tests)


def sort_model(df: DataFrame, model: Sequence[dict] | None, key: str = "play_uid", default: Sequence[Column] = ()) -> list[Column]:
    """Nulls last in both directions, ties broken on key so that pages never overlap."""
    terms = [F.col(s["colId"]).desc_nulls_last() if s.get("sort") == "desc" else F.col(s["colId"]).asc_nulls_last() for s in model or () if s.get("colId") in df.columns]
    return [*(terms or default), F.col(key).asc_nulls_last()]


def page(df: DataFrame, order: Sequence[Column], start: int, end: int) -> DataFrame:
    """Rows start to end of the order: a top-k of end rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).offset(start).limit(end - start)


def page_with_total(df: DataFrame, order: Sequence[Column], start: int, end: int) -> DataFrame:
    """A page whose rows also tell how many rows there are (total); a page past the end is empty."""
    return page(df, order, start, end).crossJoin(df.agg(F.count(F.lit(1)).alias("total")))  # one row


def scopes(side: str, power: Sequence[str], dated: tuple[str, int], top: str = "FBS") -> dict[str, Column]:
    """Populations of plays by their side's conference and division of that season.

    power conferences are always of the first rank, the dated one through its last season there and never in `others`.
    A side without a conference is in `all` and, by its division, in `top` only.
    """
    conference, division = F.col(f"{side}_conference"), F.col(f"{side}_division")
    of = conference.isin(*power)
    return {
        "power": of | ((conference == dated[0]) & (F.col("season") <= dated[1])), "lasting": of,
        "others": (division == top) & ~of & (conference != dated[0]), "top": division == top, "all": F.lit(True),
    }


def clamped(n: int | None, default: int = 50, most: int = 500) -> int:
    return max(1, min(int(n if n is not None else default), most))


def optional(df: DataFrame, **equals) -> DataFrame:
    """Only the predicates whose value is given."""
    return df.where(all_of(F.col(c) == v for c, v in equals.items() if v is not None))


def matching(column: str, text: str, how: str = "contains") -> Column:
    """Case-blind text search; wildcards in text are letters."""
    low, want = F.lower(F.col(column)), text.lower()
    return low.contains(want) if how == "contains" else low.startswith(want) if how == "prefix" else low == want


def either(value, *columns: str) -> Column:
    """value in any of the columns."""
    return F.lit(value).isin(*[F.col(c) for c in columns])


def pairs(df: DataFrame, wanted: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Rows whose tuple of columns is one of wanted: a semi-join with the literal rows."""
    types = [df.schema[c] for c in columns]
    from pyspark.sql import types as T

    return df.join(df.sparkSession.createDataFrame(list(wanted), T.StructType(types)), list(columns), "left_semi")
