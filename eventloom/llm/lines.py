"""Line dedup by site-relative frequency.

Per host, the pages that hold a line are divided by the pages of the host; lines above a ratio are
boilerplate of that host and leave its pages.  A line is compared without outer blanks; blank lines
are structure: never counted, never dropped.

Defined results: a null text stays null and counts as a page without lines; rows with a null host
form one host; repeated rows are pages each; a host whose line is on fewer than min_pages pages
keeps it (a site of one page has no boilerplate); texts are split whole, however long; an empty table
gives an empty result.  Other columns pass through untouched, whatever their names, but for ones named
like the two numbers, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, fresh, saved

#: A line on more than this share of a host's pages is boilerplate.  Measured over all sources: licence
#: lines stand on 0.6 to 1.1 % of a source's pages, passages of over 250 characters on 0.5 % at most on average.
MAX_RATIO = 0.005
#: ... and on at least so many of them.
MIN_PAGES = 5


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def host_key(host: str) -> Column:
    """Null hosts are one host of their own, apart from the empty name."""
    return F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("-"))


def boilerplate(docs: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(el_host, el_lines): hosts with the hashes of their boilerplate lines.

    Lines shuffle as (host, hash), counted on the map side first; a page counts a line once, as its
    distinct hashes are taken before the explode.  A host has at most (lines per page / max_ratio)
    such lines, however many pages it has.
    """
    pages = docs.select(host_key(host).alias("el_host"), F.col(text).alias("el_text"))
    kept = F.filter(F.split("el_text", "\n"), lambda x: F.trim(x) != "")
    counts = (
        pages.select("el_host", F.explode(F.array_distinct(F.transform(kept, line_hash))).alias("el_line"))
        .groupBy("el_host", "el_line").agg(F.count(F.lit(1)).alias("el_n"))
        .where(F.col("el_n") >= min_pages)
    )
    totals = pages.groupBy("el_host").agg(F.count(F.lit(1)).alias("el_pages"))
    often = counts.join(totals, "el_host").where(F.col("el_n") > F.col("el_pages") * max_ratio)
    return often.groupBy("el_host").agg(F.collect_set("el_line").alias("el_lines"))


def without_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, total: str = "el_lines_total", dropped: str = "el_lines_dropped") -> DataFrame:
    """docs with the boilerplate lines gone from text, and the numbers of lines in total and dropped.

    The table of boilerplate is saved and measured: within the broadcast limit the pages never
    shuffle; beyond it the join is a shuffle join on the host that AQE may split where a host is hot.
    """
    key, bad, left = fresh(docs, "el_host", "el_lines", "el_left")
    found = saved(boilerplate(docs, host, text, max_ratio, min_pages))
    found = broadcast_if_small(found, F.length("el_host") + F.size("el_lines") * 8).withColumnsRenamed({"el_host": key, "el_lines": bad})
    lines, known = F.split(F.col(text), "\n"), F.col(bad).isNotNull()
    stays = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(bad), line_hash(x)))
    n = F.coalesce(F.size(lines), F.lit(0))
    return (
        docs.withColumn(key, host_key(host)).join(found, key, "left")
        .withColumn(left, F.when(known, stays).otherwise(lines))
        .withColumn(total, F.when(F.col(text).isNull(), 0).otherwise(n))
        .withColumn(dropped, F.when(F.col(text).isNull(), 0).otherwise(n - F.size(left)))
        .withColumn(text, F.when(known, F.array_join(left, "\n")).otherwise(F.col(text)))
        .drop(key, bad, left)
    )
