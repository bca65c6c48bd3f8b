"""A read-only SQL entry point: Spark's own parser tells what a statement is, and only that is looked at.

A statement passes if it is one query over allowed tables without functions that reach outside; its
rows are limited.  The plan may hold only the nodes of READING, and no name that is computed.  The table
rule looks at every relation of the plan, subqueries and CTEs included; a name counts as a CTE only
where that CTE is in scope and if it is written without a schema.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import ParseException

DEFAULT_ROWS, MOST_ROWS = 200, 2000
#: Plan nodes of a query; any other is refused, whatever a later parser may bring.
READING = {
    "Aggregate", "CTERelationRef", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project",
    "RebalancePartitions", "Repartition", "RepartitionByExpression", "Sample", "Sort", "SubqueryAlias", "Union", "UnresolvedHaving", "UnresolvedHint", "UnresolvedInlineTable", "UnresolvedRelation",
    "UnresolvedSubqueryColumnAliases", "UnresolvedWith", "Unpivot", "Window", "WithWindowDefinition",
}
#: Built-in functions that run code, read files or reveal the session; functions that are not built in are refused whatever their name.
REFUSED_FUNCTIONS = {
    "java_method", "reflect", "try_reflect", "read_files", "input_file_name", "input_file_block_start", "input_file_block_length",
    "current_user", "session_user", "user", "current_database", "current_schema", "current_catalog", "version",
}


class Refused(ValueError):
    """The statement is not one this entry point runs."""


@dataclass
class Report:
    tables: list[str] = field(default_factory=list)
    limit: int = DEFAULT_ROWS
    limit_source: str = "default"
    truncated: bool = False


def _list(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _nodes(plan, scope: frozenset[str] = frozenset()) -> Iterator[tuple]:
    """Every node and the CTE names it may see: children, plans of subquery expressions, definitions of CTEs.

    A CTE is seen by the definitions after it and by its own query, and by nothing beside them.
    """
    yield plan, scope
    if plan.nodeName() == "UnresolvedWith":
        for pair in _list(plan.cteRelations()):
            yield from _nodes(pair._2(), scope)
            scope |= {pair._1().lower()}
    for child in _list(plan.children()):
        yield from _nodes(child, scope)
    for sub in _list(plan.subqueries()):
        yield from _nodes(sub, scope)


def _expressions(expression) -> Iterator:
    yield expression
    for child in _list(expression.children()):
        yield from _expressions(child)


def _plain_function(spark: SparkSession, parts: list[str]) -> bool:
    """One of Spark's own functions, not on the list, and not hidden by one of the session's."""
    if len(parts) != 1 or parts[0] in REFUSED_FUNCTIONS:
        return False
    jvm = spark._jvm.org.apache.spark.sql.catalyst
    name = jvm.FunctionIdentifier(parts[0])
    builtin = jvm.analysis.FunctionRegistry.builtin().functionExists(name) or jvm.analysis.TableFunctionRegistry.builtin().functionExists(name)
    return builtin and not spark._jsparkSession.sessionState().catalog().isTemporaryFunction(name)


def _own_limit(plan) -> int | None:
    """The limit that the statement itself ends with, behind WITH too; a computed one counts for the number it is."""
    while plan.nodeName() == "UnresolvedWith":
        plan = plan.child()
    if plan.nodeName() != "GlobalLimit":
        return None
    try:
        return int(plan.limitExpr().eval(None))
    except Exception as e:  # it names a column or a function
        raise Refused("a limit must be a number") from e


def check(spark: SparkSession, sql: str, allowed: Iterable[str], schema: str | None = None) -> Report:
    """The tables and the limit of an acceptable statement; raises Refused for any other."""
    if not sql or not sql.strip():
        raise Refused("the statement is empty")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise Refused(f"not one readable statement: {str(e).splitlines()[0]}") from e
    allowed = {a.lower() for a in allowed}
    found: set[str] = set()
    for n, ctes in _nodes(plan):
        name = n.getClass().getSimpleName().rstrip("$")
        if name not in READING:
            raise Refused(f"{name} is no part of a query that may run here")
        for e in (x for top in _list(n.expressions()) for x in _expressions(top)):
            kind = e.getClass().getSimpleName()
            if "UnresolvedIdentifier" in kind:
                raise Refused("names that are computed are not allowed")
            if kind == "UnresolvedFunction" and not _plain_function(spark, parts := [p.lower() for p in _list(e.nameParts())]):
                raise Refused(f"function {'.'.join(parts)} is not allowed")
            if kind == "UnresolvedAttribute" and ".".join(_list(e.nameParts())).lower() in REFUSED_FUNCTIONS:
                raise Refused(f"{e.sql()} is not allowed")
        if name == "UnresolvedRelation":
            parts = [p.lower() for p in _list(n.multipartIdentifier())]
            if len(parts) == 1 and parts[0] in ctes:
                continue
            if len(parts) > 2 or (len(parts) == 2 and parts[0] != (schema or "").lower()) or parts[-1] not in allowed:
                raise Refused(f"table {'.'.join(parts)} is not allowed")
            found.add(parts[-1])
    report = Report(sorted(found))
    own = _own_limit(plan)
    if own is not None:
        report.limit, report.limit_source = min(own, MOST_ROWS), "statement" if own <= MOST_ROWS else "capped"
    return report


def _limited(spark: SparkSession, sql: str, allowed: Iterable[str], schema: str | None, limit: int | None) -> Report:
    report = check(spark, sql, allowed, schema)
    if limit is not None:
        report.limit, report.limit_source = max(1, min(int(limit), MOST_ROWS)), "caller" if limit <= MOST_ROWS else "capped"
    return report


def run(spark: SparkSession, sql: str, allowed: Iterable[str], schema: str | None = None, limit: int | None = None) -> tuple[DataFrame, Report]:
    """The rows of an acceptable statement, limited: by the caller's limit if given, else by the statement's own, at most MOST_ROWS.

    truncated says whether the statement has more rows than that.  The statement runs once: one row more than
    the limit is taken, and the frame given holds those taken.
    """
    report = _limited(spark, sql, allowed, schema, limit)
    rows = spark.sql(sql)
    taken = rows.limit(report.limit + 1).collect()
    report.truncated = len(taken) > report.limit
    return spark.createDataFrame(taken[:report.limit], rows.schema), report


#: Seconds that a statement may run.
MOST_SECONDS = 60


class TimedOut(RuntimeError):
    """The statement ran longer than it may and was cancelled."""


def answer(spark: SparkSession, sql: str, allowed: Iterable[str], schema: str | None = None, limit: int | None = None, explain_only: bool = False, seconds: float = MOST_SECONDS) -> dict:
    """The result contract: columns (repeated names stay), rows as lists, row_count, tables, limit, truncated, explain_only.

    The statement's jobs are one group; if it runs longer than seconds, the group is cancelled, and the
    session goes on.  explain_only gives the plan as the one column and runs nothing.
    """
    report = _limited(spark, sql, allowed, schema, limit)
    result = {"tables": report.tables, "limit": report.limit, "limit_source": report.limit_source, "explain_only": explain_only}
    frame = spark.sql(sql)
    if explain_only:
        plan = frame._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return result | {"columns": ["plan"], "rows": [[line] for line in plan.splitlines()], "row_count": len(plan.splitlines()), "truncated": False}
    context, group, late = spark.sparkContext, f"guard-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        context.cancelJobGroup(group)

    timer = threading.Timer(seconds, cancel)
    context.setJobGroup(group, "guarded statement", interruptOnCancel=True)
    timer.start()
    try:
        taken = frame.limit(report.limit + 1).collect()
    except Exception as e:
        if late.is_set():
            raise TimedOut(f"the statement ran longer than {seconds} seconds") from e
        raise
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)
    rows = [list(r) for r in taken[:report.limit]]
    return result | {"columns": list(frame.columns), "rows": rows, "row_count": len(rows), "truncated": len(taken) > report.limit}


def policy(allowed: Iterable[str]) -> str:
    """The rules as a text, from the values the checks use."""
    return f"One SELECT over: {', '.join(sorted(allowed))}. {DEFAULT_ROWS} rows unless a limit is given, {MOST_ROWS} at most. Not allowed: {', '.join(sorted(REFUSED_FUNCTIONS))}."
