"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

A bounded pool of rows is sampled by hash, the trees are grown one group per tree, and every row is
scored in Arrow batches against the shipped forest. Pool, trees and forest have fixed sizes, whatever
the table holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.operators.quantiles import exact_quantiles

SAMPLE_SIZE = 256
TREES = 100
#: Rows the trees are drawn from: a tree's worth for each.
POOL_ROWS = SAMPLE_SIZE * TREES
TREE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, depth double"


def expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes of one random tree; a leaf holds the depth its points still would need."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[tuple] = []
    todo = [(0, points, 0)]
    free = 1
    while todo:
        node, part, depth = todo.pop()
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spread > 0)
        if depth >= limit or len(part) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + expected_depth(len(part))))
            continue
        feature = int(rng.choice(usable))
        low, high = part[:, feature].min(), part[:, feature].max()
        split = float(rng.uniform(low, high))
        goes_left = part[:, feature] <= split
        nodes.append((node, feature, split, free, free + 1, 0.0))
        todo.append((free, part[goes_left], depth + 1))
        todo.append((free + 1, part[~goes_left], depth + 1))
        free += 2
    return nodes


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles with NULL replaced by the column's exact median."""
    rows = exact_quantiles(df, columns, (0.5,)).select("column", "q50").collect()  # one per column
    medians = {r["column"]: r["q50"] for r in rows}
    return df.withColumns(
        {
            f"_f{i}": F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c, 0.0)))
            for i, c in enumerate(columns)
        }
    )


def fit_forest(
    df: DataFrame, columns: Sequence[str], row_id: Sequence[str], seed: int = 42, pool_rows: int = POOL_ROWS
) -> pd.DataFrame:
    """Grow the forest; returns at most ``TREES * 2 * SAMPLE_SIZE`` node rows.

    The trees draw from the ``pool_rows`` rows with the smallest hashes. A threshold on the hash leaves
    about twice as many before anything is sorted.
    """
    names = [f"_f{i}" for i in range(len(columns))]
    share = min(1.0, 2.0 * pool_rows / max(df.count(), 1))
    pool = (
        df.select(*names, F.xxhash64(F.lit(seed), *row_id).alias("_h"))
        .filter(F.col("_h") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
        .orderBy("_h", *names)
        .limit(pool_rows)
    )
    spread = pool.select(*names, F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "_h")
    from pyspark.sql import Window

    w = Window.partitionBy("tree").orderBy(F.xxhash64("_h", "tree"), *names)
    drawn = spread.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= SAMPLE_SIZE)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf.sort_values("_r")[names].to_numpy(dtype=float)
        rows = grow_tree(points, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(rows, columns=["node", "feature", "split", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        return out

    return drawn.groupBy("tree").applyInPandas(build, TREE_SCHEMA).toPandas()


def pack(nodes: pd.DataFrame) -> list[dict[str, np.ndarray]]:
    trees = []
    for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
        trees.append({c: part[c].to_numpy() for c in ("feature", "split", "left", "right", "depth")})
    return trees


def path_lengths(points: np.ndarray, trees: list[dict[str, np.ndarray]]) -> np.ndarray:
    total = np.zeros(len(points))
    rows = np.arange(len(points))
    for t in trees:
        at = np.zeros(len(points), dtype=np.int64)
        while True:
            feature = t["feature"][at]
            inner = feature >= 0
            if not inner.any():
                break
            value = points[rows, np.maximum(feature, 0)]
            step = np.where(value <= t["split"][at], t["left"][at], t["right"][at])
            at = np.where(inner, step, at)
        total += t["depth"][at]
    return total / len(trees)


def score(
    df: DataFrame, columns: Sequence[str], row_id: Sequence[str], seed: int = 42, pool_rows: int = POOL_ROWS
) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1); higher is more isolated. ``pool_rows`` bounds what the trees see."""
    full = _complete(df, columns)
    nodes = fit_forest(full, columns, row_id, seed, pool_rows)
    size = float(SAMPLE_SIZE)
    trees = pack(nodes)
    if trees:
        size = float(min(SAMPLE_SIZE, full.limit(SAMPLE_SIZE).count()))
    shipped = df.sparkSession.sparkContext.broadcast(trees)
    norm = expected_depth(size) or 1.0

    @F.pandas_udf("double")
    def isolation(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = shipped.value
        for cols in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            yield pd.Series(np.power(2.0, -path_lengths(points, forest) / norm))

    names = [f"_f{i}" for i in range(len(columns))]
    return full.withColumn("anomaly_score", isolation(*names)).drop(*names)


def flag_isolated(scored: DataFrame, contamination: float = 0.05) -> Column:
    """True above the score that leaves the wanted share of rows; exact quantile of the scores."""
    cut = exact_quantiles(scored, ["anomaly_score"], (1.0 - min(contamination, 0.5),)).drop("column", "n")
    row = cut.first()
    return F.col("anomaly_score") > F.lit(row[0] if row else None)
