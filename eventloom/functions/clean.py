"""Cleaning and typing of text columns: every cast is total, what cannot be read is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(column(c)), F.lit(""))


def to_int(c: str | Column) -> Column:
    """Feeds write whole numbers as '3', '3.0' or nothing: through decimal, so no large id loses digits."""
    return blank_to_null(c).try_cast("decimal(24,4)").try_cast("bigint")


def to_bool(c: str | Column) -> Column:
    return blank_to_null(c).try_cast("boolean")


def to_date(c: str | Column) -> Column:
    """The date in the first ten characters."""
    return F.substring(blank_to_null(c), 1, 10).try_cast("date")


def same_id(a: str | Column, b: str | Column) -> Column:
    """Ids of either spelling are equal; two unknown ids are not."""
    return to_int(a) == to_int(b)


def bounded(c: str | Column, low: float, high: float) -> Column:
    """Out of range is unknown, never the bound."""
    return F.when(column(c).between(low, high), column(c))


def clock_seconds(c: str | Column) -> Column:
    """'mm:ss' or 'h:mm:ss' in seconds; null unless every part is a number."""
    parts = F.split(blank_to_null(c), ":")
    return F.aggregate(parts, F.lit(0), lambda s, p: s * 60 + p.try_cast("int"))


def seconds_label(c: str | Column) -> Column:
    s = column(c)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(two(F.floor(s / 60)), F.lit(":"), two(s % 60))


def floor_band(c: str | Column, width: int) -> Column:
    return (F.floor(column(c) / width) * width).cast("int")


def sequence_number(uid: str | Column) -> Column:
    """The number that leads the third part of a uid, whatever follows it (':pat', '#2')."""
    return F.nullif(F.regexp_extract(F.split_part(column(uid), F.lit(":"), F.lit(3)), "^[0-9]+", 0), F.lit("")).try_cast("bigint")


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """An all-text frame with columns cast by kind: int, bool, date, timestamp, text."""
    cast = {"int": to_int, "bool": to_bool, "date": to_date, "timestamp": lambda c: blank_to_null(c).try_cast("timestamp"), "text": blank_to_null}
    return df.select(*[cast[kinds.get(c, "text")](c).alias(c) for c in df.columns])


SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


def name_key(name: str | Column) -> Column:
    """(initial, surname) in lower case without suffixes: 'T.Ab' and 'Tarik Ab Jr.' meet."""
    words = F.filter(F.split(F.lower(F.regexp_replace(column(name), r"\.", " ")), r"\s+"), lambda w: w != "")
    plain = F.when(F.size(words) > 2, F.filter(words, lambda w: ~w.isin(*SUFFIXES))).otherwise(words)
    return F.when(F.size(plain) > 0, F.concat_ws(" ", F.substring(F.element_at(plain, 1), 1, 1), F.when(F.size(plain) > 1, F.element_at(plain, -1))))
