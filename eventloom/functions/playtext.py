"""Kick texts read by ordered rules, in two dialects, with a fallback between them.

A rule is a pattern and the fields its groups give; rules are tried in order, traps first, and the first
that matches decides.  Narrative texts say "punt for 41 yds, D.Back returns for 6 yds"; gamebook texts say
"punts 41 yards to XX 20, Center-A.Snap. D.Back to XX 26 for 6 yards".  Each dialect reads a text into one
struct; where the first could not read it at all, the second's reading is taken whole.

Everything is a native column expression, laid out in a few steps so that no pattern is read twice.  What a text does not state is null: if none of the five ends
of a kick is told, nor a block, all five are unknown rather than false.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENDS = ("touchback", "fair_catch", "downed", "out_of_bounds", "returned")
FIELDS = {
    "yards": "int", "net": "int", "return_yds": "int", "made": "boolean", "kicker": "string", "returner": "string", "blocker": "string", "miss_reason": "string",
    **dict.fromkeys(ENDS, "boolean"), "blocked": "boolean", "onside": "boolean", "muffed": "boolean", "returned_for_td": "boolean", "negated": "boolean", "confidence": "string",
}
#: Readings from worst to best.
CONFIDENCE = ("none", "partial", "ambiguous", "exact")
#: What a distance may be: the shortest field goal there is, and the length of the field.
LEAST_FIELD_GOAL, FIELD = 17, 100

_CAP = r"[A-ZÀ-Þ][^\s,;()\d]*"
NAME = rf"(?:#\d{{1,2}}\s+)?(?:{_CAP},\s?{_CAP}|(?:{_CAP}\s+){{0,3}}{_CAP})"
SHORT_NAME = r"[A-Z][A-Za-z]{0,3}\.(?:\s?[A-Z][\w'’-]+)+"
AMOUNT = r"no gain|(?:a\s+)?loss of \d+\s*yards?|-?\d+\s*(?:yds?|yards?)"


@dataclass(frozen=True)
class Rule:
    """pattern gives fields by group number; sets are fields with a fixed value; last: nothing else of the text is read."""

    pattern: str
    groups: dict[str, int] = field(default_factory=dict)
    sets: dict[str, object] = field(default_factory=dict)
    last: bool = False


def first_match(text: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(the number of the first rule that matches, a struct of the groups it gives); null without a match."""
    which, said = F.lit(None).cast("int"), F.lit(None)
    names = sorted({n for r in rules for n in r.groups})
    for i, rule in reversed(list(enumerate(rules))):
        own = F.struct(*[(F.nullif(F.regexp_extract(text, rule.pattern, rule.groups[n]), F.lit("")) if n in rule.groups else F.lit(None).cast("string")).alias(n) for n in names])
        hit = text.rlike(rule.pattern)
        which, said = F.when(hit, F.lit(i)).otherwise(which), F.when(hit, own).otherwise(said)
    return which, said


def one(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def amount(text: Column) -> Column:
    """no gain is 0, a loss is negative."""
    low = F.lower(text)
    return F.when(low.contains("no gain"), 0).when(low.contains("loss of"), -one(low, r"loss of (\d+)").try_cast("int")).otherwise(one(low, r"(-?\d+)").try_cast("int"))


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[(values[n] if n in values else F.lit(None)).cast(kind).alias(n) for n, kind in FIELDS.items()])


class Steps:
    """A frame that grows by columns of one prefix."""

    def __init__(self, df: DataFrame, prefix: str):
        self.df, self.prefix = df, prefix

    def put(self, **columns: Column) -> list[Column]:
        self.df = self.df.withColumns({f"{self.prefix}{n}": c for n, c in columns.items()})
        return [F.col(f"{self.prefix}{n}") for n in columns]


def people(steps: Steps, **names: Column) -> list[Column]:
    """Names without jersey number, the feed's own nulls, and what stands before them of another sentence."""
    held = dict(zip(names, steps.put(**{f"{k}_0": F.regexp_replace(F.regexp_replace(n, r"^\s*#\d+\s*", ""), r"\s+N/A\b\.?\s*$", "") for k, n in names.items()}), strict=True))
    foreign = {k: F.upper(n).contains("PENALTY") | (F.size(F.split(F.trim(n), r"\s+")) > 4) for k, n in held.items()}
    own = {k: F.when(foreign[k], one(n, r"([A-Z][A-Za-z.'’-]*(?:\s+[A-Z][A-Za-z.'’-]*){0,2})\s*$")).otherwise(n) for k, n in held.items()}
    held = dict(zip(names, steps.put(**{f"{k}_1": F.regexp_replace(F.regexp_replace(n, r"\s+", " "), r"^[ .,-]+|[ .,-]+$", "") for k, n in own.items()}), strict=True))
    return steps.put(**{f"{k}_2": F.when(~F.lower(n).isin("", "null", "n/a", "team", "none"), n) for k, n in held.items()})


def _read(steps: Steps, text: Column, kind: str, rules: Sequence[Rule], ends: dict[str, Column], moved: Column, who: Column, blocker: Column, negated: Column, scored: Column, doubtful: Column) -> Column:
    """A dialect's struct from the rule that matched and from the clauses of the text."""
    which, said = first_match(text, rules)
    which, said, moved, who, blocker, negated, scored, blocks, muffs, doubtful, *told = steps.put(
        which=which, said=said, moved=moved, who=who, blocker=blocker, negated=negated, scored=scored,
        blocks=text.rlike(r"(?i)\bblocked\b"), muffs=text.rlike(r"(?i)\bmuff(?:s|ed)\b"), doubtful=doubtful, **ends,
    )
    fixed = lambda name: F.coalesce(*[F.when(which == i, F.lit(r.sets[name])) for i, r in enumerate(rules) if name in r.sets], F.lit(None))
    got = lambda name: said[name] if any(name in r.groups for r in rules) else F.lit(None).cast("string")
    matched = which.isNotNull()
    trap = matched & which.isin(*[i for i, r in enumerate(rules) if r.last]) if any(r.last for r in rules) else F.lit(False)
    trap, stated, back = steps.put(trap=trap, stated=got("yards").try_cast("int"), back=amount(got("back")))
    who, blocker, kicker, first = people(steps, who=who, blocker=blocker, kicker=got("kicker"), first=got("returner"))
    (rest,) = people(steps, rest=F.substr(who, F.length(blocker) + 1))  # a returner's name may begin with the blocker's
    read = matched & ~trap
    blocked = F.when(trap, F.coalesce(fixed("blocked"), F.lit(False))).when(read, blocks)
    flags = {k: F.when(trap, False).when(read, v) for k, v in zip(ends, told, strict=True)} | {"returned": F.when(trap, True).when(read, moved.isNotNull())}
    blocked, *flagged = steps.put(blocked=blocked, **{f"is_{k}": v for k, v in flags.items()})
    flags = dict(zip(flags, flagged, strict=True))
    known = F.coalesce(blocked, F.lit(False))
    for v in flags.values():
        known = known | F.coalesce(v, F.lit(False))
    yards = F.when(stated.between(LEAST_FIELD_GOAL if kind == "field_goal" else 0, FIELD), stated)
    if kind == "punt":  # a blocked punt travels no distance
        yards = F.when(blocked & stated.isNull(), 0).otherwise(yards)
    dead = F.coalesce(flags["out_of_bounds"], F.lit(False)) & moved.isNotNull()
    own = F.when(blocker.isNotNull() & F.lower(who).startswith(F.lower(blocker)), F.coalesce(rest, who)).otherwise(who)
    known, yards, dead, returner = steps.put(known=known, yards=F.when(read, yards), dead=dead, returner=own)
    run = F.when(trap, back).when(read & ~dead, F.when(moved.isNotNull(), amount(moved)).when(known & F.lit(kind != "field_goal"), 0))
    (run,) = steps.put(run=run)
    wrong = (stated.isNotNull() & yards.isNull()) | dead | doubtful | negated
    confidence = F.when(~matched, "none").when(trap | (muffs & moved.isNull()), "partial").when(wrong, "ambiguous").when(kicker.isNotNull(), "exact").otherwise("partial")
    values = {
        "yards": yards, "return_yds": run, "kicker": F.when(read, kicker), "returner": F.when(trap, first).when(read, returner), "blocker": F.when(read, blocker),
        "blocked": blocked, "muffed": F.when(matched, muffs), "negated": F.when(matched, negated), "onside": F.when(matched, text.rlike(r"(?i)\bon-?\s?side\b")),
        "returned_for_td": F.when(trap, F.coalesce(fixed("returned_for_td"), scored)).when(read, moved.isNotNull() & scored), "confidence": confidence,
    }
    if kind == "field_goal":
        result = F.upper(F.coalesce(got("result"), F.lit("GOOD")))
        missed = F.lower(one(text, r"(?i)\b(wide right|wide left|short|hit (?:the )?(?:right |left )?upright|blocked)\b"))
        values |= {"made": F.when(trap, False).when(read & ~negated, result == "GOOD"), "miss_reason": F.when(read & (result != "GOOD"), missed), "onside": F.lit(None)}
    else:
        values |= {k: F.when(known, v) for k, v in flags.items()}
    if kind == "punt":
        values |= {"net": F.when(known, yards - run), "onside": F.lit(None)}
    (out,) = steps.put(out=F.struct(*[(values[n] if n in values else F.lit(None)).cast(t).alias(n) for n, t in FIELDS.items()]))
    return out


NARRATIVE = {
    "field_goal": (
        Rule(r"(?i)(\d{1,3})\s*Yds?\s+Return\s+of\s+Blocked\s+(?:Field\s+Goal|FG)", {"back": 1}, {"blocked": True}, True),
        Rule(r"(?i)(\d{1,3})\s*Yds?\s+Return\s+of\s+Missed\s+(?:Field\s+Goal|FG)", {"back": 1}, {"blocked": False}, True),
        Rule(r"(?i)^(.+?)\s+field goal attempt from\s+(\d{1,2})(?:\s+yards?)?\s*(?:nullified by penalty)?\s*(NO GOOD|GOOD|MISSED|BLOCKED|RETURNED)", {"kicker": 1, "yards": 2, "result": 3}),
        Rule(r"(?i)^(.+?)\s+(\d{1,2})\s*(?:yds?|yards?)\s+(?:FG|Field\s+Goal)\s+(GOOD|MISSED|BLOCKED|RETURNED)", {"kicker": 1, "yards": 2, "result": 3}),
        Rule(r"(?i)^(.+?)\s+(\d{1,2})\s*(?:yds?|yards?)\s+Field\s+Goal\s*$", {"kicker": 1, "yards": 2}),
    ),
    "punt": (
        Rule(r"(?i)^(.+?)\s+(\d{1,3})\s*Yds?\s+Punt\s+Return", {"returner": 1, "back": 2}, {"returned_for_td": True}, True),
        Rule(r"(?i)^(.*?)\s*punt for\s+(\d{1,3})\s*yds?", {"kicker": 1, "yards": 2}),
        Rule(r"(?i)^(.*?)\s*punt\s+(\d{1,3})\s+yards?\s+(?:from the \S+\s+)?to the", {"kicker": 1, "yards": 2}),
        Rule(r"(?i)^(.*?)\s*punt\b", {"kicker": 1}),
    ),
    "kickoff": (
        Rule(r"(?i)^(.+?)\s+(\d{1,3})\s*Yds?\s+Kickoff\s+Return", {"returner": 1, "back": 2}, {"returned_for_td": True}, True),
        Rule(r"(?i)^(.*?)\s*kick(?:off)? for\s+(\d{1,3})\s*yds?", {"kicker": 1, "yards": 2}),
        Rule(r"(?i)^(.*?)\s*kickoff\s+(\d{1,3})\s+yards?\s+(?:from the \S+\s+)?to the", {"kicker": 1, "yards": 2}),
        Rule(r"(?i)^(.*?)\s*(?:on-?\s?side kick|kickoff)\b", {"kicker": 1}),
    ),
}
GAMEBOOK = {
    "field_goal": (
        Rule(rf"^({SHORT_NAME})\s+(\d{{1,2}})\s+yard field goal is (?i:(GOOD|No Good|BLOCKED))", {"kicker": 1, "yards": 2, "result": 3}),
    ),
    "punt": (
        Rule(rf"^({SHORT_NAME})\s+punts\s+(-?\d{{1,3}})\s+yards?\s+(?:from \S+ \S+ )?to\s", {"kicker": 1, "yards": 2}),
        Rule(rf"^({SHORT_NAME})\s+punt is BLOCKED", {"kicker": 1}),
    ),
    "kickoff": (
        Rule(rf"^({SHORT_NAME})\s+kicks\s+(?:onside\s+)?(-?\d{{1,3}})\s+yards?\s+from\s", {"kicker": 1, "yards": 2}),
    ),
}


def narrative(steps: Steps, t: Column, kind: str) -> Column:
    verb = r"return(?:s|ed)?\s+(?:for\s+|of\s+)?"
    named = rf"({NAME})\s+{verb}({AMOUNT})"  # of two such clauses the one that names somebody
    caught = one(t, r"(?i)fair catch by\s+([^;()]{1,45}?)\s+at\s+(?:the\s+)?\w")
    ends = {"touchback": t.rlike(r"(?i)\btouchback\b"), "fair_catch": t.rlike(r"(?i)\bfair catch\b"), "downed": t.rlike(r"(?i)\bdowned\b"), "out_of_bounds": t.rlike(r"(?i)\bout.of.bounds\b")}
    blocker = one(t, r"(?i)blocked by\s+([^,;()]{1,45}?)(?=\s*(?:,|$|\s+return|\s+blocked))")
    moved = F.coalesce(one(t, named, 2), one(t, rf"{verb}({AMOUNT})"))
    penalised = t.rlike(r"(?i)PENALTY") & t.rlike(NARRATIVE["punt"][2].pattern) if kind == "punt" else F.lit(False)
    return _read(steps, t, kind, NARRATIVE[kind], ends, moved, F.coalesce(caught, one(t, named, 1)), blocker, t.rlike(r"(?i)\bNO PLAY\b|nullified by penalty"), t.rlike(r"(?i)\bfor a TD\b|\btouchdown\b"), penalised)


def gamebook(steps: Steps, t: Column, kind: str) -> Column:
    clause = rf"(?:\.|,)\s+({SHORT_NAME})\s+(?:ran ob at |pushed ob at |to )?(?:\S+ \d{{1,2}}|50|end zone)?\s*for\s+({AMOUNT})"
    stood = t.rlike(r"(?i)\(didn't\s+try\s+to\s+advance\)")
    caught = one(t, rf"(?i:fair catch by)\s+({SHORT_NAME})")
    ends = {"touchback": t.rlike(r"(?i)\btouchback\b"), "fair_catch": t.rlike(r"(?i)\bfair catch\b"), "downed": t.rlike(r"(?i)\bdowned by\b"), "out_of_bounds": t.rlike(r"(?i)\bout of bounds\b")}
    blocker = one(t, rf"BLOCKED\s+(?:by\s+|\()({SHORT_NAME})")
    moved = F.when(~stood, one(t, clause, 2))
    return _read(steps, t, kind, GAMEBOOK[kind], ends, moved, F.coalesce(caught, F.when(~stood, one(t, clause, 1))), blocker, t.rlike(r"(?i)-\s*No\s+Play|nullified by penalty"), t.rlike(r"\bTOUCHDOWN\b(?!\s+NULLIFIED)"), F.lit(False))


def better(first: Column, second: Column) -> Column:
    """second, whole, where first could not read the text and second could."""
    return F.when((first["confidence"] == "none") & (second["confidence"] != "none"), second).otherwise(first)


def with_kick(df: DataFrame, text: str, kind: str, out: str = "kick", book: str | None = None) -> DataFrame:
    """df with the struct of FIELDS that its kick texts give, by both dialects.

    book names a boolean column: where it is true the gamebook's reading comes first.
    """
    mark = "el_"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark = f"_{mark}"
    base = Steps(df, f"{mark}text_")
    (t,) = base.put(t=F.regexp_replace(F.trim(F.col(text)), r"^\(\d{0,2}:\d{2}\)\s*", ""))
    first = Steps(base.df, f"{mark}story_")
    a = narrative(first, t, kind)
    second = Steps(first.df, f"{mark}book_")
    b = gamebook(second, t, kind)
    (gives,) = (F.lit(False),) if book is None else (F.coalesce(F.col(book), F.lit(False)),)
    return second.df.select(*df.columns, F.when(gives, better(b, a)).otherwise(better(a, b)).alias(out))
