"""SimHash near-duplicates by the generalised pigeonhole principle (operator 7).

Two fingerprints that differ in at most ``radius`` bits differ, for thresholds t_1..t_m with sum
radius - m + 1, in at most t_i bits of some partition i (t_i = -1 leaves a partition out). Correlated bits
share a partition; the thresholds are chosen by dynamic programming on candidate counts from the histogram
of each partition's values, over all fingerprints. Large value groups, where pairs would grow with the
square, go another exact way: fingerprints that differ in at most two bits share a neighbour at distance
one, so each meets the others at its 65 neighbours, with at most 65 fingerprints at any.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import ragged
from retropanel.llm.common import fields, release, stored, with_text_columns
from retropanel.llm.components import components
from retropanel.llm.xxh import xxh64

BITS = 64
PARTS, WIDTH = 4, 16
RADIUS = 2
DENSE = 64
_LANE = np.uint64(0x0101010101010101)


def fingerprints(rows: ragged.Texts, width: int = 3) -> np.ndarray:
    """The 64-bit fingerprint of each text: bit j is 1 if set in over half of its shingles' hashes."""
    rows = ragged.Texts(ragged.lowered(rows.data), rows.offsets)
    found = ragged.words(rows)
    data, starts, ends = ragged.joined(rows, found)
    n_words = np.diff(found.bounds)
    n = np.where(n_words > 0, np.maximum(n_words - width + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    first = ragged.spread(found.bounds[:-1], n)
    last = np.minimum(first + width, found.bounds[1:][row]) - 1
    h = xxh64(data, starts[first], ends[last])
    # bits are added up in byte lanes, at most 255 hashes at a time
    pieces = -(-n // 255)
    begins = np.repeat(np.cumsum(n) - n, pieces) + 255 * ragged.spread(np.zeros(len(n), np.int64), pieces)
    out = np.zeros(len(n), np.uint64)
    if not len(h):
        return out
    full = np.flatnonzero(n)
    first_piece = (np.cumsum(pieces) - pieces)[full]
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & _LANE, begins).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), first_piece, axis=0)
        over = ones * 2 > n[full][:, None]
        for k in range(8):
            out[full] |= over[:, k].astype(np.uint64) << np.uint64(8 * k + j)
    return out


def with_fingerprints(docs: DataFrame, text: str = "text", width: int = 3, keep: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """Kept columns and ``fp``, the fingerprint as a signed long (0 for a text without words)."""
    return with_text_columns(docs, text, fields(**{name: "bigint"}), lambda: lambda chunk: [fingerprints(chunk, width).view(np.int64)], keep)


def _per_batch(df: DataFrame, schema: str, make) -> DataFrame:
    """A function of each batch's fingerprints (unsigned) to arrays."""
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in make(fp[at : at + 20_000])], names)

    return df.select("fp").mapInArrow(run, schema)


def bit_groups(fps: DataFrame) -> list[list[int]]:
    """Bits dealt into equal partitions, correlated ones together, by their correlation over all rows."""
    pairs = [(i, j) for i in range(BITS) for j in range(i, BITS)]
    left, right = (np.array(x, np.int32) for x in zip(*pairs))

    def counts(fp: np.ndarray):
        ones = ((fp[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
        both = (ones.T @ ones).round().astype(np.int64)
        return [left, right, both[left, right], np.full(len(left), len(fp), np.int64)]

    rows = _per_batch(fps, "i int, j int, n bigint, rows bigint", counts).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).collect()
    joint, total = np.zeros((BITS, BITS)), 1.0
    for r in rows:
        joint[r["i"], r["j"]] = joint[r["j"], r["i"]] = r["n"]
        total = r["rows"]
    p = np.diag(joint) / total
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs((joint / total - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    free, groups = set(range(BITS)), []
    while free:
        group = [max(sorted(free), key=lambda b: tied[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < WIDTH:
            best = max(sorted(free), key=lambda b: tied[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def parts_of(fp: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """The value of each partition: one row for each partition."""
    out = np.zeros((len(groups), len(fp)), np.int64)
    for p, group in enumerate(groups):
        for k, bit in enumerate(group):
            out[p] |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def histograms(fps: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of each partition: PARTS x 2^WIDTH numbers, whatever the rows."""

    def counts(fp: np.ndarray):
        part, value, n = [], [], []
        for p, values in enumerate(parts_of(fp, groups)):
            v, c = np.unique(values, return_counts=True)
            part.append(np.full(len(v), p, np.int32)), value.append(v.astype(np.int32)), n.append(c)
        return [np.concatenate(x) for x in (part, value, n)]

    got = _per_batch(fps, "part int, value int, n bigint", counts).groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(groups), 1 << WIDTH), np.int64)
    out[got["part"].to_numpy(), got["value"].to_numpy()] = got["n"].to_numpy()
    return out


def flips(bits: int, most: int) -> np.ndarray:
    """The masks of up to so many of the lowest ``bits`` bits, the empty one first; none below 0."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def candidate_costs(counts: np.ndarray, radius: int) -> np.ndarray:
    """Rows to probe and candidates to verify for each partition at thresholds -1, 0, .. radius."""
    costs = np.zeros((len(counts), radius + 2))
    n, value = counts.sum(axis=1), np.arange(1 << WIDTH)
    for p, c in enumerate(counts):
        for t in range(radius + 1):
            masks = flips(WIDTH, t).astype(np.int64)
            met = sum(float(np.dot(c, np.minimum(c[value ^ m], DENSE))) for m in masks)
            costs[p, t + 1] = met + 4.0 * len(masks) * n[p]
    return costs


def thresholds(costs: np.ndarray, radius: int) -> list[int]:
    """The cheapest thresholds with sum radius - partitions + 1, by dynamic programming over partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                now = (cost + row[t + 1], [*chosen, t])
                if total + t not in step or now < step[total + t]:
                    step[total + t] = now
        best = step
    return best[radius - len(costs) + 1][1]


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever distinct fingerprints (column fp) differ in at most RADIUS bits.

    Small value groups give every such pair; members of large ones (over DENSE) give edges to the smallest
    of those around a common neighbour, which connects the same fingerprints.
    """
    groups = bit_groups(fps)
    counts = histograms(fps, groups)
    limits = thresholds(candidate_costs(counts, RADIUS), RADIUS)
    dense = counts > DENSE
    used = [(p, flips(WIDTH, t).astype(np.int64)) for p, t in enumerate(limits) if t >= 0]

    def rows_of(fp: np.ndarray, probing: bool):
        """Keys (partition, value) of fingerprints that meet in small groups."""
        parts, key, own = parts_of(fp, groups), [], []
        for p, masks in used:
            for m in masks if probing else masks[:1]:
                value = parts[p] ^ m
                at = np.flatnonzero(~dense[p][value])
                key.append((p << WIDTH) | value[at])
                own.append(fp[at].view(np.int64))
        return [np.concatenate(key), np.concatenate(own)]

    def around(fp: np.ndarray):
        """The neighbours at distance 0 and 1 of fingerprints that meet a large group."""
        parts = parts_of(fp, groups)
        met = np.zeros(len(fp), bool)
        for p, masks in used:
            for m in masks:
                met |= dense[p][parts[p] ^ m]
        masks = flips(BITS, 1)
        own = fp[met]
        return [(own[:, None] ^ masks).ravel().view(np.int64), np.repeat(own, len(masks)).view(np.int64)]

    held = _per_batch(fps, "key bigint, fp bigint", lambda fp: rows_of(fp, False))
    asked = _per_batch(fps, "key bigint, fp bigint", lambda fp: rows_of(fp, True)).withColumnRenamed("fp", "other")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS
    # where all thresholds are 0 a pair meets from both sides, and one is enough
    near = held.join(asked, (held["key"] == asked["key"]) & ((F.col("fp") < F.col("other")) if all(len(m) == 1 for _, m in used) else (F.col("fp") != F.col("other"))) & close)
    star = _per_batch(fps, "centre bigint, fp bigint", around).groupBy("centre").agg(F.collect_list("fp").alias("all")).filter(F.size("all") > 1)
    star = star.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).filter("a <> b")
    return near.select(F.col("fp").alias("a"), F.col("other").alias("b")).union(star)


def _labelled(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints with the ``component`` that links put them in."""
    fps = stored(fps, "distinct-fingerprints")
    labels = components(links(fps)).withColumnRenamed("node", "fp")
    return fps.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the component is the smallest doc_id that links lead to, itself included.

    Copies share a fingerprint and never meet as pairs: links are sought between distinct fingerprints, whose
    smallest doc_id is a partial aggregate. Texts without words have fingerprint 0 and link like any other;
    null is such a text; fewer words than a shingle give one shingle of them all; repeated rows keep their
    number; a null doc_id has a component but never names one; an empty table gives an empty result.
    """
    rows = stored(with_fingerprints(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text", width), "fingerprints")
    labelled = _labelled(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    names = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3) -> DataFrame:
    """The rows of ``docs``, one of each component of ``near_duplicates``: that with the smallest doc_id, null
    last, then the first as stored.

    Rows are told apart by a stored number, so a doc_id may repeat or be missing, and all columns stay,
    whatever their names. Texts without words (null included) are one component with whatever is within
    the radius of fingerprint 0. An empty table gives an empty result.
    """
    counted = docs.withColumn("__num__", F.monotonically_increasing_id())
    rows = stored(with_fingerprints(counted, text, width, tuple(counted.columns), "__fp__"), "fingerprinted")
    first = F.min(F.struct(F.col(f"`{doc_id}`").isNull().alias("nameless"), F.col(f"`{doc_id}`").alias("doc_id"), F.col("__num__").alias("num"))).alias("first")
    kept = _labelled(rows.groupBy(F.col("__fp__").alias("fp")).agg(first)).groupBy("component").agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.num").alias("__num__")), "__num__", "left_semi").select(*[f"`{c}`" for c in docs.columns])
