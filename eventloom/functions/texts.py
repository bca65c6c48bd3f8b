"""Play texts as rows: ordered regular expressions as native column expressions.

Each parser returns a struct column.  A value a text does not state is null; an attempt a penalty
took back has an unknown outcome, not a failed one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.clean import bounded, column

# What a play's type is called in feeds, and the kick it is.
KICK_TYPES = {
    "Field Goal Good": "field_goal", "Field Goal Missed": "field_goal", "Blocked Field Goal": "field_goal", "Missed Field Goal Return": "field_goal",
    "Blocked Field Goal Touchdown": "field_goal", "Missed Field Goal Return Touchdown": "field_goal",
    "Punt": "punt", "Blocked Punt": "punt", "Punt Return Touchdown": "punt", "Blocked Punt Touchdown": "punt",
    "Kickoff": "kickoff", "Kickoff Return (Offense)": "kickoff", "Kickoff Return Touchdown": "kickoff",
}


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def number(text: Column, *patterns: str) -> Column:
    """The first pattern that matches decides."""
    return F.coalesce(*[found(text, p).try_cast("int") for p in patterns])


def kick_family(kind: str | Column, text: str | Column) -> Column:
    """By type first, then by what the text says was done.

    How a team lined up says nothing: formations are taken out first, so fakes and penalties before the
    snap are no kicks.
    """
    t = F.regexp_replace(F.lower(column(text)), r"\([^()]*\bformation\b[^()]*\)", " ")
    field_goal = t.rlike(r"\b(?:yds?|yards?|yrds?) (?:fg|field goal)\b|\bfield goal (?:attempt|try|is|good|missed|no good|blocked)\b|\b(?:blocked|missed) (?:fg|field goal)\b")
    punt = t.rlike(r"\bpunts?\b") & ~t.rlike(r"\bfakes?\b")
    kickoff = t.rlike(r"\bkicks\b|\bkick ?off\b|\bkick for -?\d+|\bon-?side kick\b")
    by_type = F.create_map(*[F.lit(x) for pair in KICK_TYPES.items() for x in pair])[column(kind)]
    return F.coalesce(by_type, F.when(field_goal, "field_goal").when(punt, "punt").when(kickoff, "kickoff"))


def return_yards(text: str | Column) -> Column:
    """The return clause: no gain is 0, a loss is negative; yard lines ('to the USU38') are no returns."""
    t = column(text)
    clause = F.coalesce(found(t, r"(?i)\breturn(?:s|ed)?\b(.*)"), F.lit(""))
    lost = number(clause, r"(?i)\ba?\s*loss of (\d+)")
    gained = number(clause, r"(?i)^\s*(?:for )?(\d+) (?:yds?|yards?)\b", r"(?i)\bfor (\d+) (?:yds?|yards?)\b")
    first = number(t, r"(?i)\b(\d+) yds? (?:punt|kickoff|kick) return\b", r"(?i)^(\d+) yd return of")
    return F.when(clause.rlike(r"(?i)^\s*for no gain\b"), 0).when(lost.isNotNull(), -lost).otherwise(F.coalesce(first, gained))


def field_goal(text: str | Column) -> Column:
    """struct(distance, made, blocked, negated, confidence)."""
    t = column(text)
    back = t.rlike(r"(?i)\breturn of (?:a )?blocked field goal|\bmissed fg return")
    negated = t.rlike(r"(?i)nullified by penalty")
    blocked = t.rlike(r"(?i)\bblocked\b")
    distance = F.when(~back, number(t, r"(?i)\b(\d+) (?:yds?|yards?) (?:fg|field goal)\b", r"(?i)field goal attempt from (\d+)"))
    good, bad = t.rlike(r"(?i)\bgood\b") & ~t.rlike(r"(?i)no good"), t.rlike(r"(?i)no good|\bmissed\b|wide (?:left|right)")
    made = F.when(negated, None).when(back | blocked | bad, F.lit(False)).when(good, F.lit(True))
    legal = bounded(distance, 17, 80)
    confidence = F.when(negated | (distance.isNotNull() & legal.isNull()), "ambiguous").when(back, "partial").when(legal.isNotNull() & made.isNotNull(), "exact").when(legal.isNotNull() | made.isNotNull(), "partial").otherwise("none")
    return F.struct(legal.alias("distance"), made.alias("made"), blocked.alias("blocked"), negated.alias("negated"), confidence.alias("confidence"))


END_FLAGS = {"touchback": r"(?i)\btouchback\b", "fair_catch": r"(?i)\bfair catch\b", "out_of_bounds": r"(?i)\bout[ -]of[ -]bounds\b", "downed": r"(?i)\bdowned\b", "returned": r"(?i)\breturn(?:s|ed)?\b"}


def kick_away(text: str | Column, kind: str) -> Column:
    """Punts and kickoffs: struct(gross, net, return_yds, blocked, onside, five end flags, confidence).

    If a text states none of the five ends and no block, all five are unknown rather than false.
    """
    t = column(text)
    trap = t.rlike(rf"(?i)\b\d+ yds? {'punt' if kind == 'punt' else 'kickoff'} return\b")
    verbs = r"punts?" if kind == "punt" else r"kick(?:s|off)?"
    gross = F.when(~trap, number(t, rf"(?i)\b{verbs} (?:onside )?(?:for )?(\d+) (?:yds?|yards?)\b", rf"(?i)\b(\d+) yards? {verbs}\b"))
    gross = bounded(gross, 0, 100)
    blocked, onside = t.rlike(r"(?i)\bblocked\b"), t.rlike(r"(?i)\bonside\b")
    flags = {k: t.rlike(p) for k, p in END_FLAGS.items()}
    known = blocked | flags["touchback"] | flags["fair_catch"] | flags["out_of_bounds"] | flags["downed"] | flags["returned"]
    back = F.when(flags["returned"], return_yards(t))
    net = F.when(known & ~flags["touchback"], gross - F.coalesce(back, F.lit(0)))
    confidence = F.when(trap, "partial").when(gross.isNotNull(), "exact").when(known, "partial").otherwise("none")
    ends = [F.when(known, f).alias(k) for k, f in flags.items()]
    return F.struct(gross.alias("gross"), net.alias("net"), back.alias("return_yds"), blocked.alias("blocked"), onside.alias("onside"), *ends, confidence.alias("confidence"))


def conversion(text: str | Column) -> Column:
    """The first parenthesis that tells a try: struct(kind, converted, kicker)."""
    t = column(text)
    tries = F.filter(F.regexp_extract_all(t, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda p: p.rlike(r"(?i)\bkick\b|\bpat\b|two-point|\b(?:pass|run) (?:for|failed)"))
    own = F.coalesce(F.get(tries, F.lit(0)), F.when(t.rlike(r"(?i)two-point conversion attempt"), found(t, r"(?i)(two-point conversion attempt.*)")))
    two = own.rlike(r"(?i)two-point|\b(?:pass|run)\b")
    failed = own.rlike(r"(?i)\bfail(?:s|ed)\b|\bmissed\b|\bblocked\b|no good")
    return F.struct(
        F.when(own.isNull(), None).when(two, "two_point").otherwise("pat").alias("kind"), F.when(own.isNotNull(), ~failed).alias("converted"),
        F.when(~two & ~failed, F.nullif(F.trim(F.regexp_replace(own, r"(?i)\s*\b(?:kick|pat)\b.*", "")), F.lit(""))).alias("kicker"),
    )


def clean_name(name: str | Column) -> Column:
    """Without clock, jersey number and placeholders."""
    n = F.regexp_replace(F.regexp_replace(column(name), r"^\s*\(\d*:\d\d\)\s*", ""), r"^\s*#\d+\s*", "")
    return F.when(~F.lower(F.trim(n)).isin("n/a", "null", "unknown", "team"), F.nullif(F.trim(n), F.lit("")))


def better(first: Column, second: Column) -> Column:
    """second's reading only where first could not read the text at all."""
    return F.when((first["confidence"] == "none") & (second["confidence"] != "none"), second).otherwise(first)


def snap_crew(text: str | Column) -> Column:
    """struct(snapper, holder) where a gamebook names them."""
    t = column(text)
    return F.struct(found(t, r"\bCenter-([\w.'-]+?)(?=[,.]?\s|[,.]?$)").alias("snapper"), found(t, r"\bHolder-([\w.'-]+?)(?=[,.]?\s|[,.]?$)").alias("holder"))
