"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves; the leaves of a group (a language) stand in the order of their ids, and eight consecutive
nodes become their parent until one is left, the group's subroot; subroots become the root likewise.

Executors reduce large blocks of leaves, each block a row of digests, to one node each, and blocks of
those again while more than TOP nodes are left.  The driver builds the small tree above, at most TOP
nodes, and broadcasts the suffix of every block's proofs; executors put it behind the rows' own parts and
fold each row to the root again.  A group larger than a task is no trouble: places are found by ranges.

Defined results: nulls have a digest of their own (the mark -), so they differ from empty texts; null ids
come first; rows of one id are ordered by their digests, so repeated rows have leaves of their own; a
null id is never tampered with; texts are hashed whole; an empty table gives an empty result.  Only the
named columns are read, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, ranked, saved

#: Children of a node; levels that a block of leaves is reduced by (8 ** 4 leaves); nodes the driver takes over.
FAN, LEVELS, TOP = 8, 4, 4096
#: One step of a proof: what is hashed before and after the row's own node.
STEP = "struct<before:string,after:string>"


def field(value: str | Column) -> Column:
    """A value as it is hashed: its length in bytes, a colon and itself; nulls as a mark of their own."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: str | Column) -> Column:
    return digest(*map(field, values))


def folded(node: str | Column, path: str | Column) -> Column:
    """The root that a node and its proof lead to."""
    node = F.col(node) if isinstance(node, str) else node
    return F.aggregate(path, node, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def proof_digest(path: str | Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def joined(nodes: Column, a: Column, n: Column) -> Column:
    """n digests from place a (from 0) on, one behind another; nothing for n of 0."""
    return F.array_join(F.slice(nodes, a + 1, n), "")


def _raised(nodes: Column) -> Column:
    """The parents of a level's nodes."""
    runs = F.ceil(F.size(nodes) / F.lit(FAN)).cast("int")
    return F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(joined(nodes, i * FAN, F.lit(FAN)), 256))


def _step(nodes: Column, at: Column) -> Column:
    """The step from the node at a place to its parent."""
    first = (F.floor(at / FAN) * FAN).cast("int")
    return F.struct(joined(nodes, first, at - first).alias("before"), joined(nodes, at + 1, first + FAN - 1 - at).alias("after"))


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, pos, own, part): for each block of nodes (grp, pos, digest, n) its node and its rows' part of the proof.

    A group that is one block climbs until a node is left, others by all levels.
    """
    size = FAN**levels
    table = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda x: x["digest"]).alias("l0"), F.max("n").alias("n"),
    )
    for k in range(levels):
        below = F.col(f"l{k}")
        table = table.withColumn(f"l{k + 1}", F.when((F.col("n") > size) | (F.size(below) > 1), _raised(below)))
        if k:
            table = table.withColumn(f"l{k + 1}", F.when(F.col(f"l{k}").isNotNull(), F.col(f"l{k + 1}")))
    top = F.coalesce(*(F.col(f"l{k}") for k in range(levels, -1, -1)))
    at = lambda i, k: F.floor(i / FAN**k).cast("int")
    steps = lambda i: [F.when(F.col(f"l{k + 1}").isNotNull(), _step(F.col(f"l{k}"), at(i, k))) for k in range(levels)]
    rows = F.transform(F.sequence(F.lit(0), F.size("l0") - 1), lambda i: F.struct((F.col("block") * size + i).alias("pos"), F.filter(F.array(*steps(i)), lambda s: s.isNotNull()).alias("part")))
    return table.select("grp", "block", "n", F.element_at(top, 1).alias("top"), F.inline(rows))  # the levels stay behind


def _top_tree(nodes: list) -> list[tuple]:
    """The small tree of the driver: (grp, pos, subroot, root, path) of nodes (grp, pos, digest), groups in their order."""

    def climbed(row: list[tuple[str, list]]) -> str:
        """The one node above a row of (digest, members' paths); every member's path grows by a step a level."""
        while len(row) > 1:
            runs = [row[i:i + FAN] for i in range(0, len(row), FAN)]
            for run in runs:
                for i, (_, paths) in enumerate(run):
                    step = ("".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1:]))
                    for path in paths:
                        path.append(step)
            row = [(hashlib.sha256("".join(d for d, _ in run).encode()).hexdigest(), [p for _, paths in run for p in paths]) for run in runs]
        return row[0][0]

    groups: dict = {}
    for grp, pos, own in sorted(nodes, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1])):
        groups.setdefault(grp, []).append((pos, own, []))
    subroots = {g: climbed([(own, [path]) for _, own, path in members]) for g, members in groups.items()}
    root = climbed([(subroots[g], [path for _, _, path in members]) for g, members in groups.items()]) if groups else None
    return [(g, pos, subroots[g], root, path) for g, members in groups.items() for pos, _, path in members]


def proofs(nodes: DataFrame, levels: int = LEVELS, top: int = TOP) -> DataFrame:
    """(grp, pos, subroot, root, path) of saved nodes (grp string, pos from 0, digest, n nodes of the group).

    path holds the steps from the node to the root.
    """
    session, size = nodes.sparkSession, FAN**levels
    kind = f"grp string, pos bigint, subroot string, root string, path array<{STEP}>"
    left, largest, groups = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("pos") == 0, 1)), F.lit(0))).first()
    if left <= top:
        return session.createDataFrame(_top_tree([tuple(r) for r in nodes.select("grp", "pos", "digest").collect()]), kind)
    if largest == 1:  # more groups than the driver takes: their subroots are the leaves of one group
        line = saved(ranked(nodes.select(F.col("grp").alias("own"), "digest"), [], [F.col("own").asc_nulls_first()], "pos", "el_range").withColumn("grp", F.lit("")).withColumn("n", F.lit(groups)))
        above = proofs(line.select("grp", "pos", "digest", "n"), levels, top).select("pos", "root", "path")
        return line.select(F.col("own").alias("grp"), "pos", F.col("digest").alias("subroot")).join(above, "pos").select("grp", F.lit(0).cast("bigint").alias("pos"), "subroot", "root", "path")
    rows = saved(_blocks(nodes, levels))
    parents = saved(rows.where(F.col("pos") % size == 0).select("grp", F.col("block").alias("pos"), F.col("top").alias("digest"), F.ceil(F.col("n") / size).alias("n")))
    above = broadcast_if_small(saved(proofs(parents, levels, top)), F.lit(256) + F.coalesce(F.aggregate("path", F.lit(0), lambda b, s: b + F.length(s["before"]) + F.length(s["after"])), F.lit(0)))
    above = above.select(F.col("grp").alias("up"), F.col("pos").alias("block_of"), "subroot", "root", F.col("path").alias("suffix"))
    joined_up = rows.join(above, F.col("grp").eqNullSafe(F.col("up")) & (F.col("block") == F.col("block_of")))
    return joined_up.select("grp", "pos", "subroot", "root", F.concat("part", "suffix").alias("path"))


def manifest(rows: DataFrame, values: list[str], group: str, order: str, tampered: dict[str, Column] | None = None, levels: int = LEVELS, top: int = TOP) -> DataFrame:
    """(order, leaf, shown_leaf, subroot, root, path) of every row.

    values are hashed in their order; shown_leaf is the leaf with the columns of tampered in place of rows' own.
    """
    shown = [(tampered or {}).get(v, F.col(v)) for v in values]
    leaves = rows.select(F.col(order).alias("id"), F.col(group).cast("string").alias("grp"), leaf(*values).alias("digest"), leaf(*shown).alias("shown"))
    placed = ranked(saved(leaves), ["grp"], [F.col("id").asc_nulls_first(), F.col("digest"), F.col("shown")], "pos", "el_range")
    counts = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).select(F.col("grp").alias("of"), "n")
    nodes = saved(placed.join(counts, F.col("grp").eqNullSafe(F.col("of"))).select("id", "grp", "pos", "digest", "shown", "n"))
    done = proofs(nodes.select("grp", "pos", "digest", "n"), levels, top).withColumnsRenamed({"grp": "of", "pos": "at"})
    both = nodes.join(done, F.col("grp").eqNullSafe(F.col("of")) & (F.col("pos") == F.col("at")))
    return both.select(F.col("id").alias(order), F.col("digest").alias("leaf"), F.col("shown").alias("shown_leaf"), "subroot", "root", "path")
