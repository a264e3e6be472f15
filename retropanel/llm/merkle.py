"""Merkle manifest of a dataset by sibling-shift self-joins (operator 13).

Rows are leaves, numbered within their group; a level joins its nodes with themselves at the computed indices
of their siblings (XOR 1 for binary trees, slot offsets otherwise), and the rows of slot 0 emit the parents.
Each level is a written table. Proofs travel the other way: a node's path is its siblings followed by its
parent's path, so the rows joined shrink by the arity from level to level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retropanel.llm.common import stored

#: Between the siblings before and after a node, and after each level of a path; neither is a hex digit.
MIDDLE, END = ",", ";"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field_code(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*(field_code(v) for v in values))


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``idx`` (from 0, by ``order`` within equal ``group`` columns) and ``n`` (rows of the group).

    Rows are sorted in range partitions, stored with their place, and each run of a group inside a partition
    gets the number of its first row from the counts of the runs before; a group may span all partitions.
    """
    keys = [*group, *order]
    spread = rows.withColumn("tie__", F.monotonically_increasing_id())  # rows equal in all columns part by it
    places = spread.repartitionByRange(*(F.col(k) for k in keys), F.col("tie__")).sortWithinPartitions(*keys, "tie__")
    places = stored(places.drop("tie__").withColumn("at__", F.monotonically_increasing_id()), "sorted-leaves")
    places = places.withColumn("task__", F.shiftright("at__", 33))
    runs = places.groupBy(*group, "task__").agg(F.min("at__").alias("from__"), F.count("*").alias("rows__"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("task__").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"n": F.sum("rows__").over(whole), "base__": F.coalesce(F.sum("rows__").over(before), F.lit(0))}).drop("rows__")
    matched = same(places, runs, [*group, "task__"])
    return matched.withColumn("idx", F.col("base__") + F.col("at__") - F.col("from__")).drop("at__", "task__", "from__", "base__")


def same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equijoin on columns of the same names, where null equals null; the right side's keys go."""
    other = right.select(*[F.col(c).alias(f"{c}__r") if c in keys else F.col(c) for c in right.columns])
    met = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}__r")) for k in keys))
    return left.join(other, met, how).drop(*[f"{k}__r" for k in keys])


def with_siblings(nodes: DataFrame, group: Sequence[str], arity: int) -> DataFrame:
    """Nodes with the hashes of their run's others: ``before`` and ``after`` them, concatenated in order."""
    slot, parts = F.col("idx") % arity, {"before": [], "after": []}
    out = nodes
    for shift in range(1, arity):
        wanted = F.col("idx").bitwiseXOR(F.lit(1).cast("bigint")) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        other = nodes.select(*group, F.col("idx").alias("at__"), F.col("hash").alias(f"sibling{shift}__"))
        out = same(out.withColumn("at__", wanted), other, [*group, "at__"], "left")
        found = F.coalesce(f"sibling{shift}__", F.lit(""))
        parts["before"].append(F.when(slot + shift >= arity, found).otherwise(""))
        parts["after"].append(F.when(slot + shift < arity, found).otherwise(""))
    return out.select(*[f"`{c}`" for c in nodes.columns], *[F.concat(*p).alias(side) if p else F.lit("").alias(side) for side, p in parts.items()])


def climb(nodes: DataFrame, group: Sequence[str], arity: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """The levels of every group's tree with siblings, and (group, hash, height) of the groups' roots.

    Nodes have ``idx``, ``n`` and ``hash``; further columns stay on the lowest level. A group of one node is
    its own root. One number, the size of the largest group, decides the number of levels.
    """
    if arity < 2:
        raise ValueError("a run needs at least two nodes")
    levels, roots = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.filter("n = 1").select(*group, "hash", F.lit(len(levels)).alias("height")))
        if most <= 1:
            return levels, reduce(DataFrame.unionByName, roots)
        level = stored(with_siblings(nodes.filter("n > 1"), group, arity), "merkle-level")
        levels.append(level)
        parent = digest(F.col("before"), F.col("hash"), F.col("after"))
        nodes = level.filter(F.col("idx") % arity == 0).select(*group, F.expr(f"idx DIV {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) DIV {arity}").alias("n"), parent.alias("hash"))
        most = -(-most // arity)


def descend(levels: list[DataFrame], tops: DataFrame, group: Sequence[str], arity: int = 2) -> DataFrame | None:
    """The lowest level's rows with ``path``, their siblings from level to level, and ``subroot``.

    ``tops`` has (group, height, subroot, path): where each group's tree ends and how its root goes on.
    Groups of one row are not on any level (see ``proofs``). None if no group has two rows.
    """
    above = None
    for height in reversed(range(len(levels))):
        parents = tops.filter(F.col("height") == height + 1).select(*group, F.lit(0).cast("bigint").alias("parent__"), "subroot", F.col("path").alias("rest__"))
        if above is not None:
            parents = parents.unionByName(above.select(*group, F.col("idx").alias("parent__"), "subroot", F.col("path").alias("rest__")))
        joined = same(levels[height].withColumn("parent__", F.expr(f"idx DIV {arity}")), parents, [*group, "parent__"])
        path = F.concat("before", F.lit(MIDDLE), "after", F.lit(END), "rest__").alias("path")
        kept = levels[height].drop("before", "after", "n").columns if height == 0 else [*group, "idx"]
        above = joined.select(*kept, "subroot", path)
        if height:
            above = stored(above, "merkle-paths")
    return above


def proofs(leaves: DataFrame, group: Sequence[str], order: Sequence[str], arity: int = 2) -> DataFrame:
    """Leaves (``hash`` and any columns) with ``subroot``, ``root`` and ``path``.

    The groups' roots, in the order of the group columns (null first), are the leaves of one more tree, built
    the same way. Only its root, one hash, reaches the driver.
    """
    nodes = numbered(leaves, group, [*order, "hash"])
    columns = [c for c in nodes.columns if c not in ("idx", "n")]
    levels, roots = climb(nodes, group, arity)
    ends = stored(roots, "merkle-subroots")
    upper = numbered(ends.withColumn("whole__", F.lit(0)), ["whole__"], group)
    upper_levels, found = climb(upper, ["whole__"], arity)
    last = found.first()
    root = F.lit(last["hash"] if last else None).cast("string")
    end = found.select("whole__", "height", F.col("hash").alias("subroot"), F.lit("").alias("path"))
    tops = descend(upper_levels, end, ["whole__"], arity)
    lone = upper.filter("n = 1").select(*group, "height", "hash", F.lit("").alias("path"))
    tops = lone if tops is None else tops.select(*group, "height", "hash", "path").unionByName(lone)
    tops = stored(tops.select(*group, "height", F.col("hash").alias("subroot"), "path"), "merkle-tops")
    singles = same(nodes.filter("n = 1").drop("idx", "n"), tops.filter("height = 0").drop("height"), group)
    many = descend(levels, tops, group, arity)
    rows = singles if many is None else singles.select(*columns, "subroot", "path").unionByName(many.select(*columns, "subroot", "path"))
    return rows.select(*columns, "subroot", root.alias("root"), "path")


def proof_hash(path: Column) -> Column:
    """Digest of all siblings of a path, level by level."""
    return F.sha2(F.translate(path, MIDDLE + END, ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf hash and a path lead to."""
    steps = F.filter(F.split(path, END), lambda s: s != "")
    return F.aggregate(steps, start, lambda acc, s: digest(F.substring_index(s, MIDDLE, 1), acc, F.substring_index(s, MIDDLE, -1)))


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", doc_id: str = "doc_id", changed: dict[str, Column] | None = None, arity: int = 2) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, verified) for every row.

    A leaf is the digest of the coded ``fields``; leaves ascend by doc_id (null first, ties by their hash)
    within ``group`` (null is a group of its own). ``changed`` replaces fields of the rows to be checked:
    folded_root is recomputed from the changed leaf and the original siblings, and ``verified`` tells whether
    it equals the root. Texts are read once; from there on only digests move. Repeated rows are leaves of
    their own, null and empty texts have different leaves, a row alone has an empty path, an empty table
    gives no rows, and further input columns take no part.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    now = {**values, **(changed or {})}
    named = docs.select(F.col(f"`{group}`").alias("group"), F.col(f"`{doc_id}`").alias("doc_id"), leaf(*values.values()).alias("hash"), leaf(*now.values()).alias("now"))
    rows = proofs(stored(named, "merkle-leaves"), ["group"], ["doc_id"], arity)
    folded = fold(F.col("now"), F.col("path"))
    rows = rows.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
