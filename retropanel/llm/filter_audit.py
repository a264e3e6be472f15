"""How the filters of a chain interact: contingency tensor contractions (operator 11).

Every document fails or passes each of five filters, so a part is a 2x2x2x2x2 tensor of counts (axis = filter,
index 1 = fails). Whatever is asked of a step in an order of the filters is a contraction of that tensor with
one selector for each axis: pass, fail or all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.llm.common import bounded_batches, stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WORD = r"[^\x20\x09-\x0D]+"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
_PARTS_AT_ONCE = 64


def text_failures(text: Column) -> list[Column]:
    """Filters A to D on one text, true where it fails."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        F.size(words) < 50,
        F.size(F.array_distinct(words)) * F.lit(100).cast("bigint") < F.size(words) * F.lit(65).cast("bigint"),
        capitals * F.lit(100).cast("bigint") > F.length(text) * F.lit(5).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]


def failures(docs: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, part, mask): bit 4 of the mask stands for filter A, bit 0 for E; a set bit fails.

    E asks whether a smaller doc_id holds the same text anywhere in the table. Each distinct text's smallest
    doc_id is a partial aggregate, and a document looks itself up by (text digest, doc_id), so copies of a
    text never meet in one task. A row without a doc_id is neither smaller nor larger than any other and
    passes E; rows that repeat the smallest doc_id all pass.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    facts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    bits = [F.when(failed, 16 >> i).otherwise(0) for i, failed in enumerate(text_failures(F.col("text")))]
    facts = stored(facts.select("doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2("text", 256)).alias("key")), "filter-facts")
    named = facts.filter("doc_id IS NOT NULL")
    firsts = named.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    named = named.join(firsts, ["key", "doc_id"], "left")
    named = named.select("doc_id", "part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + 1).alias("mask"))
    return named.unionByName(facts.filter("doc_id IS NULL").select("doc_id", "part", "mask"))


def tensors(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): at most 32 cells (mask, n, good, toxic) for each part, from rows (doc_id, part, mask).

    A document is good or toxic if any of its rows in ``labels`` says so; labels may be null, missing or
    repeated. Cells are partial aggregates, so a part may hold most of the documents.
    """
    marked = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marked = marked.agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    nameless = rows.filter("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    known = rows.filter("doc_id IS NOT NULL").join(marked, "doc_id", "left").fillna(0, ["good", "toxic"]).unionByName(nameless)
    cells = known.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def contract(counts: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """Sums of tensors (..., 2, 2, 2, 2, 2) under selector rows, one (steps, 2) array for each axis."""
    return np.einsum("...abcde,ka,kb,kc,kd,ke->...k", counts, *axes)


def selectors(kind: str) -> list[np.ndarray]:
    """For every step of every order, what is selected along each axis."""
    rows = []
    for order in ORDERS:
        for step, letter in enumerate(order):
            before = order[:step]
            row = {
                "kept": {f: PASS if f in before + letter else ALL for f in FILTERS},
                "removed": {f: FAIL if f == letter else PASS if f in before else ALL for f in FILTERS},
                "fails": {f: FAIL if f == letter else ALL for f in FILTERS},
                "unique": {f: FAIL if f == letter else PASS for f in FILTERS},
            }[kind]
            rows.append([row[f] for f in FILTERS])
    return list(np.array(rows, np.int64).transpose(1, 0, 2))


RESULT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def audit(parts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included, from ``tensors``.

    kept after the step, removed by it, redundant (fails its filter, removed before), unique_fails (fails no
    other filter), good and toxic documents lost, shapley (removed by its filter over all orders). No parts
    give no rows; 600 rows a part are made from 96 numbers, whatever the documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked = {kind: selectors(kind) for kind in ("kept", "removed", "fails", "unique")}
        order, step = np.repeat(np.array(ORDERS, object), len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        own = np.array([FILTERS.index(f) for o in ORDERS for f in o])
        for batch in batches:
            names, cells = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(cells), _PARTS_AT_ONCE):
                some = cells[at : at + _PARTS_AT_ONCE]
                counts = np.zeros((3, len(some), 32), np.int64)
                for p, found in enumerate(some):
                    for c in found:
                        counts[:, p, c["mask"]] = c["n"], c["good"], c["toxic"]
                counts = counts.reshape(3, len(some), 2, 2, 2, 2, 2)
                kept, fails, unique = (contract(counts[0], picked[k]) for k in ("kept", "fails", "unique"))
                removed, good, toxic = contract(counts, picked["removed"])
                shapley = np.stack([removed[:, own == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)[:, own]
                values = [kept, removed, fails - removed, unique, good, toxic, shapley]
                part = names.slice(at, len(some)).take(pa.array(np.repeat(np.arange(len(some)), len(own))))
                columns = [part, pa.array(np.tile(order, len(some)), pa.string()), pa.array(np.tile(step, len(some)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v.ravel()) for v in values)], [f.split()[0] for f in RESULT.split(", ")])

    return bounded_batches(parts).mapInArrow(run, RESULT)
