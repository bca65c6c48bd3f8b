"""Queries of the kick texts: sentences of both dialects laid over the events, every field read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import playtext
from eventloom.plans.binding import Tables
from eventloom.plans.registry import query

#: (kind, dialect, text, what it says).  {y} is a distance and {r} a return, both of the event; what is said is SQL over y and r.
TEXTS = (
    ("punt", "story", "A.Foot punt for {y} yds, D.Back returns for {r} yds to the OWN 40", {"yards": "y", "net": "y - r", "return_yds": "r", "kicker": "'A.Foot'", "returner": "'D.Back'", "returned": "true", "confidence": "'exact'"}),
    ("punt", "story", "(07:53) #41 Ben Long punt for {y} yds , downed at the OWN 4", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'Ben Long'", "downed": "true", "confidence": "'exact'"}),
    ("punt", "story", "Galitz,Drew punt {y} yards to the USU20, fair catch by Moss,Al at the USU20", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'Galitz,Drew'", "returner": "'Moss,Al'", "fair_catch": "true", "confidence": "'exact'"}),
    ("punt", "story", "Galitz,Drew punt {y} yards to the USU20, Moss,Al return {r} yards, PENALTY UT holding", {"yards": "y", "net": "y - r", "return_yds": "r", "kicker": "'Galitz,Drew'", "returner": "'Moss,Al'", "returned": "true", "confidence": "'ambiguous'"}),
    ("punt", "story", "Adoree' Jackson {r} Yd Punt Return (Matt Cummins Kick)", {"return_yds": "r", "returner": "'Adoree'' Jackson'", "returned": "true", "returned_for_td": "true", "confidence": "'partial'"}),
    ("punt", "story", "Al Foot punt blocked by Wyatt Ray Dee Moss return for a loss of {r} yards", {"yards": "0", "net": "r", "return_yds": "-r", "kicker": "'Al Foot'", "blocker": "'Wyatt Ray Dee Moss'", "returner": "'Wyatt Ray Dee Moss'", "blocked": "true", "returned": "true", "confidence": "'exact'"}),
    ("punt", "story", "Al Foot punt for {y} yds", {"yards": "y", "kicker": "'Al Foot'", "confidence": "'exact'"}),
    ("punt", "story", "Al Foot punt for {y} yds, Dee Moss muffed at the OWN 3, recovered by TECH", {"yards": "y", "kicker": "'Al Foot'", "muffed": "true", "confidence": "'partial'"}),
    ("punt", "story", "Al Foot punt for {y} yds, out of bounds, Dee Moss return for {r} yds", {"yards": "y", "kicker": "'Al Foot'", "returner": "'Dee Moss'", "returned": "true", "out_of_bounds": "true", "confidence": "'ambiguous'"}),
    ("punt", "story", "TEAM punt for {y} yds for a touchback", {"yards": "y", "net": "y", "return_yds": "0", "touchback": "true", "confidence": "'partial'"}),
    ("punt", "story", "PENALTY UT sideline interference 15 yards to the UT20. Mitchell Becker punt for {y} yds for a touchback NO PLAY", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'Mitchell Becker'", "touchback": "true", "negated": "true", "confidence": "'ambiguous'"}),
    ("punt", "book", "(2:01) A.Cole punts {y} yards to DAL 20, Center-R.Lovato. C.Lamb to DAL 31 for {r} yards (T.Name).", {"yards": "y", "net": "y - r", "return_yds": "r", "kicker": "'A.Cole'", "returner": "'C.Lamb'", "returned": "true", "confidence": "'exact'"}),
    ("punt", "book", "A.Cole punts {y} yards to DAL 20, Center-R.Lovato, fair catch by C.Lamb.", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'A.Cole'", "returner": "'C.Lamb'", "fair_catch": "true", "confidence": "'exact'"}),
    ("punt", "book", "A.Cole punts {y} yards to end zone, Center-R.Lovato, Touchback. Penalty on DAL - No Play.", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'A.Cole'", "touchback": "true", "negated": "true", "confidence": "'ambiguous'"}),
    ("punt", "book", "A.Cole punt is BLOCKED by F.Cox, Center-R.Lovato.", {"yards": "0", "net": "0", "return_yds": "0", "kicker": "'A.Cole'", "blocker": "'F.Cox'", "blocked": "true", "confidence": "'exact'"}),
    ("punt", "book", "Al Foot punt for {y} yds, Dee Moss returns for no gain", {"yards": "y", "net": "y", "return_yds": "0", "kicker": "'Al Foot'", "returner": "'Dee Moss'", "returned": "true", "confidence": "'exact'"}),
    ("punt", "story", "Timeout OWN, clock 03:1{r}", None),
    ("kickoff", "story", "Al Foot kickoff for {y} yds , Dee Moss return for {r} yds to the OWN 30", {"yards": "y", "return_yds": "r", "kicker": "'Al Foot'", "returner": "'Dee Moss'", "returned": "true", "confidence": "'exact'"}),
    ("kickoff", "story", "Al Foot kickoff for {y} yds , , return for no gain to the OWN 35 , Dee Moss return for {r} yds for a TD", {"yards": "y", "return_yds": "r", "kicker": "'Al Foot'", "returner": "'Dee Moss'", "returned": "true", "returned_for_td": "true", "confidence": "'exact'"}),
    ("kickoff", "story", "Deebo Samuel 9{r} Yd Kickoff Return (Elliott Fry Kick)", {"return_yds": "CAST('9' || r AS INTEGER)", "returner": "'Deebo Samuel'", "returned": "true", "returned_for_td": "true", "confidence": "'partial'"}),
    ("kickoff", "story", "Al Foot kickoff for 1{y} yds for a touchback", {"return_yds": "0", "kicker": "'Al Foot'", "touchback": "true", "confidence": "'ambiguous'"}),
    ("kickoff", "story", "Al Foot on-side kick recovered by DUKE at the DUKE {y}", {"kicker": "'Al Foot'", "onside": "true", "confidence": "'exact'"}),
    ("kickoff", "book", "J.Elliott kicks {y} yards from PHI 35 to end zone, Touchback.", {"yards": "y", "return_yds": "0", "kicker": "'J.Elliott'", "touchback": "true", "confidence": "'exact'"}),
    ("kickoff", "book", "J.Elliott kicks {y} yards from PHI 35 to DAL 5. K.Turpin to DAL 20 for {r} yards (T.Name), TOUCHDOWN NULLIFIED by Penalty.", {"yards": "y", "return_yds": "r", "kicker": "'J.Elliott'", "returner": "'K.Turpin'", "returned": "true", "negated": "true", "confidence": "'ambiguous'"}),
    ("kickoff", "book", "J.Elliott kicks onside {r} yards from PHI 35 to PHI 44. T.Pollard (didn't try to advance) to PHI 44 for no gain.", {"yards": "r", "kicker": "'J.Elliott'", "onside": "true", "confidence": "'exact'"}),
    ("field_goal", "story", "A.Foot {y} yd FG GOOD", {"yards": "y", "made": "true", "kicker": "'A.Foot'", "confidence": "'exact'"}),
    ("field_goal", "story", "(09:34) #98 I.Hankins field goal attempt from {y} yards MISSED wide right", {"yards": "y", "made": "false", "miss_reason": "'wide right'", "kicker": "'I.Hankins'", "confidence": "'exact'"}),
    ("field_goal", "story", "I.Hankins field goal attempt from {y} yards nullified by penaltyGOOD", {"yards": "y", "negated": "true", "kicker": "'I.Hankins'", "confidence": "'ambiguous'"}),
    ("field_goal", "story", "I.Hankins {y} yd FG BLOCKED blocked by Wyatt Ray, Dee Moss return for {r} yds for a TD", {"yards": "y", "made": "false", "miss_reason": "'blocked'", "blocked": "true", "blocker": "'Wyatt Ray'", "returner": "'Dee Moss'", "return_yds": "r", "returned_for_td": "true", "kicker": "'I.Hankins'", "confidence": "'exact'"}),
    ("field_goal", "story", "Dee Moss 6{r} Yd Return of Blocked Field Goal for a TD", {"return_yds": "CAST('6' || r AS INTEGER)", "made": "false", "blocked": "true", "returned_for_td": "true", "confidence": "'partial'"}),
    ("field_goal", "story", "D. Dzioban 1{r} yd FG GOOD", {"yards": "CASE WHEN 10 + r >= 17 THEN 10 + r END", "made": "true", "kicker": "'D. Dzioban'", "confidence": "CASE WHEN 10 + r >= 17 THEN 'exact' ELSE 'ambiguous' END"}),
    ("field_goal", "story", "Cade York {y} Yd Field Goal", {"yards": "y", "made": "true", "kicker": "'Cade York'", "confidence": "'exact'"}),
    ("field_goal", "book", "B.McManus {y} yard field goal is No Good, Wide Left, Center-A.Snap, Holder-B.Hold.", {"yards": "y", "made": "false", "miss_reason": "'wide left'", "kicker": "'B.McManus'", "confidence": "'exact'"}),
    ("field_goal", "book", "B.McManus {y} yard field goal is BLOCKED (F.Cox), Center-A.Snap.", {"yards": "y", "made": "false", "miss_reason": "'blocked'", "blocked": "true", "blocker": "'F.Cox'", "kicker": "'B.McManus'", "confidence": "'exact'"}),
)


def _expected(kind: str, name: str, said: dict | None) -> str:
    """The field as SQL: what is said, or what follows where nothing is."""
    if said is None:
        return "'none'" if name == "confidence" else "NULL"
    if name in said:
        return said[name]
    told = any(said.get(e) for e in playtext.ENDS) or "blocked" in said
    if name in playtext.ENDS:
        return "false" if told and kind != "field_goal" else "NULL"
    if name in ("blocked", "muffed", "negated", "returned_for_td"):
        return "false"
    return "false" if name == "onside" and kind == "kickoff" else "NULL"


def _kind(kind: str, name: str) -> None:
    own = [(i, t) for i, t in enumerate(TEXTS) if t[0] == kind]
    sql = {"int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    columns = ", ".join(f"CAST(CASE k {' '.join(f'WHEN {j} THEN {_expected(kind, f, t[3])}' for j, (_, t) in enumerate(own))} END AS {sql[c]}) AS {f}" for f, c in playtext.FIELDS.items())
    oracle = f"SELECT event_id, {columns} FROM (SELECT event_id, event_id % {len(own)} AS k, CAST(20 + event_id % 41 AS INTEGER) AS y, CAST(1 + event_id % 9 AS INTEGER) AS r FROM events)"

    @query(name, oracle, play_tables=False)
    def read_back(t: Tables) -> DataFrame:
        e = F.col("event_id")
        y, r = (20 + e % 41).cast("string"), (1 + e % 9).cast("string")
        k = e % len(own)
        text = reduce(lambda rest, x: F.when(k == x[0], F.replace(F.replace(F.lit(x[1][1][2]), F.lit("{y}"), y), F.lit("{r}"), r)).otherwise(rest), enumerate(own), F.lit(None).cast("string"))
        book = reduce(lambda a, b: a | b, [k == j for j, (_, x) in enumerate(own) if x[1] == "book"], F.lit(False))
        rows = t.raw("events").select("event_id", text.alias("text"), book.alias("book"))
        return playtext.with_kick(rows, "text", kind, book="book").select("event_id", "kick.*")


for _k, _n in (("field_goal", "p02_field_goals_both_dialects"), ("punt", "p03_punts_both_dialects"), ("kickoff", "p04_kickoffs_both_dialects")):
    _kind(_k, _n)
