"""Exact top-k inner products over a vector-approximation file (operator 1).

Vectors are quantised to cells, a few bits for each dimension. A scan of the cells gives a lower and an upper
bound of every score; exact vectors are then read in the order of their bounds until the kth result is
certain. Scores are similarities here, so the best bound is the highest one.

Equal vectors are one entry with its smallest ids: a query takes at most k results, so an entry never needs
more than the k + 1 smallest (one may be the query itself), and copies don't multiply candidates. An id with
several vectors asks on its own, and its scans leave out the entries that nobody else has, so every entry
met stands for at least one other id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm.common import stored

BITS = 6
CELL_BLOCK = 2048
QUERY_BLOCK = 256
SALT_BLOCKS = 8
#: Components times the scale stay below this, so that products and their sums are exact longs.
LARGEST = 1 << 26
_NOBODY = -(1 << 63)


def quantised(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long. A row takes no part if its id or vector is
    null or empty, or a component null, not finite or, times the scale, LARGEST or more from zero."""
    x = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), x.alias("x")).filter("vec_id IS NOT NULL AND size(x) > 0")
    rows = rows.filter(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / scale)))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """(gid, v, ids): distinct vectors with their ``most`` smallest ids, ascending; gid is the first of them
    (with the vector's hash, should one id have several vectors). The number of ids per key is cut before
    the shuffle, so a vector that fills the table sends a few rows from each task."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("rank__", rank).filter(F.col("rank__") <= most)
    grouped = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.struct(F.element_at("ids", 1).alias("id"), F.xxhash64("v").alias("h")).alias("gid"), "v", "ids")


def marks(file: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the cell borders of its dimensions: quantiles over all entries.

    One number for each (length, dimension, cell), however many vectors there are.
    """
    cells = 1 << BITS
    each = file.select(F.size("v").alias("dims"), F.posexplode("v").alias("d", "x"))
    got = each.groupBy("dims", "d").agg(F.percentile_approx("x", [k / cells for k in range(1, cells)], 1000).alias("inner"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    out: dict[int, np.ndarray] = {}
    for r in got:
        out.setdefault(r["dims"], np.zeros((r["dims"], cells + 1)))[r["d"]] = [r["low"], *r["inner"], r["high"] + 1]
    return {k: np.maximum.accumulate(v, axis=1) for k, v in out.items()}


def to_cells(v: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The cell of each component, a byte each: cell c holds borders[c] <= x < borders[c + 1]."""
    return np.stack([np.searchsorted(b[1:-1], v[:, d], "right") for d, b in enumerate(borders)], 1).astype(np.uint8)


def bounds(queries: np.ndarray, cell: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every query's score with every vector, from its cells."""
    at = np.arange(len(borders))
    low, high = borders[at, cell], borders[at, cell + 1] - 1
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _blocks(rows: DataFrame, size: int, borders: dict[int, np.ndarray] | None) -> DataFrame:
    """Rows of one vector length in blocks of bounded size: (dims, n, ids, hashes, sole, body). The body is
    cells if borders are given, else the exact vectors; ``sole`` marks entries of a single id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for k in np.unique(dims).tolist():
                at = np.flatnonzero(dims == k)
                for a in range(0, len(at), size):
                    part = batch.take(pa.array(at[a : a + size]))
                    v = _matrix(part.column(3))
                    body = to_cells(v, borders[k]).tobytes() if borders else v.astype("<i8").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([len(v)], pa.int32()), *(pa.array([part.column(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()) for c in (0, 1)), pa.array([part.column(4).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()), pa.array([body], pa.binary())],
                        ["dims", "n", "ids", "hashes", "sole", "body"],
                    )

    flat = rows.select(F.col("gid.id").alias("id"), F.col("gid.h").alias("h"), F.size("v").alias("dims"), "v", (F.size("ids") == 1).alias("sole"))
    return flat.mapInArrow(run, "dims int, n int, ids binary, hashes binary, sole binary, body binary")


def _scan(pairs: DataFrame, borders: dict[int, np.ndarray], k: int, known: bool) -> DataFrame:
    """Scan blocks of cells with blocks of queries. First for the k highest lower bounds of each query in
    each block, (qid, qh, low); then, with those known, for all candidates, (qid, qh, id, h, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                queries = np.frombuffer(row["q_body"], "<i8").reshape(-1, dims).astype(np.float64)
                cell = np.frombuffer(row["body"], np.uint8).reshape(row["n"], dims)
                low, high = bounds(queries, cell, borders[dims])
                own = np.frombuffer(row["q_alone"], "<i8")
                if (own != _NOBODY).any():
                    away = np.frombuffer(row["sole"], np.uint8).astype(bool) & (own[:, None] == np.frombuffer(row["ids"], "<i8"))
                    low[away] = high[away] = -np.inf
                qid, qh = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_hashes"], "<i8")
                if not known:
                    top = -np.partition(-low, min(k, low.shape[1]) - 1, axis=1)[:, :k]
                    real = top.ravel() > -np.inf
                    columns = [np.repeat(qid, top.shape[1])[real], np.repeat(qh, top.shape[1])[real], top.ravel()[real]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "qh", "low"])
                else:
                    q, x = np.nonzero((high >= np.frombuffer(row["q_least"], "<f8")[:, None]) & (high > -np.inf))
                    ids, h = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["hashes"], "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (qid[q], qh[q], ids[x], h[x], high[q, x])], ["qid", "qh", "id", "h", "high"])

    return pairs.mapInArrow(run, "qid bigint, qh bigint, id bigint, h bigint, high double" if known else "qid bigint, qh bigint, low double")


def _query_blocks(queries: DataFrame, lows: bool) -> DataFrame:
    """Query rows (qid, qh, dims, v, alone and, if known, the least bound) in numbered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for k in np.unique(dims).tolist():
                at = np.flatnonzero(dims == k)
                for a in range(0, len(at), QUERY_BLOCK):
                    part = batch.take(pa.array(at[a : a + QUERY_BLOCK]))
                    plain = [part.column(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in (0, 1)]
                    alone = part.column(4).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                    least = part.column(5).to_numpy(zero_copy_only=False).astype("<f8").tobytes() if lows else b""
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in (*plain, _matrix(part.column(3)).astype("<i8").tobytes(), alone, least))], ["q_dims", "q_ids", "q_hashes", "q_body", "q_alone", "q_least"])

    return queries.mapInArrow(run, "q_dims int, q_ids binary, q_hashes binary, q_body binary, q_alone binary, q_least binary")


def _pairs(cells: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of cells with every block of queries of its length. Cells are dealt into salts, and each
    query block goes to every salt, so no task holds more than SALT_BLOCKS blocks of cells for one of
    queries."""
    counted = {r["dims"]: r["n"] for r in cells.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    salts = max([1, *(-(-n // SALT_BLOCKS) for n in counted.values())])
    salted = cells.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int"))
    spread = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("shuffle_hash")
    return salted.join(spread, (salted["dims"] == spread["q_dims"]) & (salted["salt"] == spread["salt"])).select("dims", "n", "ids", "hashes", "sole", "body", "q_ids", "q_hashes", "q_body", "q_alone", "q_least").repartition(F.xxhash64("ids", "q_ids"))


def _exact(candidates: DataFrame, file: DataFrame, queries: DataFrame) -> DataFrame:
    """Candidates with their exact scores and the ids of their entries."""
    x = file.select(F.col("gid.id").alias("id"), F.col("gid.h").alias("h"), F.col("v").alias("x"), "ids")
    score = F.aggregate(F.zip_with("x", "v", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, c: s + c)
    return candidates.join(x, ["id", "h"]).join(queries.select("qid", "qh", "v", "alone"), ["qid", "qh"]).select("qid", "qh", "alone", "ids", score.alias("score"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query row with all
    other rows of its length, ties to the smaller vec_id; all of them if there are fewer than k.

    ``is_query`` is a condition on vec_id. Vectors that are null, empty, or hold null or non-finite
    components, or such of 2**18 or more from zero (whose scores need not fit a long), take no part; rows
    that repeat both id and vector count once; an id with several vectors is a query and a candidate with
    each, never its own, and has k results over all of them. Vectors of different lengths are not compared. An
    empty table gives an empty result.
    """
    rows = stored(quantised(vectors, vector, vec_id), "vectors")
    file = stored(entries(rows, k + 1), "va-file")
    borders = marks(file)
    asked = rows.filter(is_query).distinct()
    # copies of a query vector are searched once, for one result more, as each leaves itself out
    keyed = file.select(F.col("gid.id").alias("qid"), F.col("gid.h").alias("qh"), F.size("v").alias("dims"), "v")
    several = asked.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id")
    single = asked.join(several, "vec_id", "left_anti")
    shared = keyed.join(single.select("v").distinct(), "v", "left_semi").select("qid", "qh", "dims", "v", F.lit(_NOBODY).alias("alone"))
    lone = asked.join(several, "vec_id").select(F.col("vec_id").alias("qid"), F.xxhash64("v", F.lit("alone")).alias("qh"), F.size("v").alias("dims"), "v", F.col("vec_id").alias("alone"))
    queries = stored(shared.unionByName(lone), "queries")
    cells = stored(_blocks(file, CELL_BLOCK, borders), "cells")
    lows = _scan(_pairs(cells, _query_blocks(queries, False)), borders, k + 1, False)
    # an entry stands for one id at least, so the (k + 1)th highest lower bound is sure to be reached
    by_low = Window.partitionBy("qid", "qh").orderBy(F.desc("low"))
    least = lows.withColumn("rank__", F.row_number().over(by_low)).filter(F.col("rank__") <= k + 1).groupBy("qid", "qh").agg(F.when(F.count("*") > k, F.min("low")).otherwise(F.lit(float("-inf"))).alias("least"))
    bounded = queries.join(least, ["qid", "qh"]).select("qid", "qh", "dims", "v", "alone", "least")
    candidates = stored(_scan(_pairs(cells, _query_blocks(bounded, True)), borders, k + 1, True), "candidates")
    # read in the order of bounds: the first 2(k + 1), then whatever could still pass the (k + 1)th of those
    by_high = Window.partitionBy("qid", "qh").orderBy(F.desc("high"), "id", "h")
    head = candidates.withColumn("rank__", F.row_number().over(by_high)).filter(F.col("rank__") <= 2 * (k + 1)).drop("rank__")
    first = stored(_exact(head, file, queries), "first-scores")
    by_score = Window.partitionBy("qid", "qh").orderBy(F.desc("score"))
    sure = first.withColumn("rank__", F.row_number().over(by_score)).filter(F.col("rank__") == k + 1).select("qid", "qh", F.col("score").alias("sure"))
    rest = candidates.join(sure, ["qid", "qh"]).filter("high >= sure").select("qid", "qh", "id", "h").join(head.select("qid", "qh", "id", "h"), ["qid", "qh", "id", "h"], "left_anti")
    scored = first.union(_exact(rest, file, queries))
    flat = scored.select("qid", "qh", "alone", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> alone").drop("alone")
    best = Window.partitionBy("qid", "qh").orderBy(F.desc("score"), "vec_id")
    few = flat.withColumn("rank__", F.row_number().over(best)).filter(F.col("rank__") <= k + 1).drop("rank__")
    owners = single.join(keyed, "v").select(F.col("vec_id").alias("query_id"), "qid", "qh")
    owners = owners.unionByName(queries.filter(F.col("alone") != _NOBODY).select(F.col("alone").alias("query_id"), "qid", "qh"))
    mine = owners.join(few, ["qid", "qh"]).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return mine.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
