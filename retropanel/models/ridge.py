"""Ridge over many penalties and folds from the Gram matrices of the blocks.

A block's moments (count, means, products around the means) are gathered in one scan; the training rows of an
expanding fold are the merged moments of its blocks, so every fold and penalty is solved, and its squared
error on held-out rows known, from features x features numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.models.metrics import compute_metrics
from retropanel.operators.moments import pair_moments


@dataclass(frozen=True)
class Gram:
    """Moments of rows: count, means, and sums of products around the means; the label is the last column."""

    n: float
    mean: np.ndarray
    product: np.ndarray

    def merge(self, other: Gram) -> Gram:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        return Gram(n, self.mean + apart * (other.n / n), self.product + other.product + np.outer(apart, apart) * (self.n * other.n / n))

    def solve(self, alpha: float) -> Line:
        """Least squares with ``alpha`` times the squared coefficients; the intercept goes free."""
        xx, xy = self.product[:-1, :-1], self.product[:-1, -1]
        beta = np.linalg.lstsq(xx + alpha * np.eye(len(xx)), xy, rcond=None)[0]
        return Line(beta, float(self.mean[-1] - self.mean[:-1] @ beta))

    def squared_error(self, line: Line) -> float:
        """Mean squared error of a line on these rows."""
        side = np.append(-line.coefficients, 1.0)
        bias = float(self.mean @ side - line.intercept)
        return max(float(side @ self.product @ side) / self.n, 0.0) + bias * bias


@dataclass(frozen=True)
class Line:
    coefficients: np.ndarray
    intercept: float

    def value(self, features: Column) -> Column:
        """The prediction for an array column of features."""
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        return F.aggregate(F.zip_with(features, weights, lambda x, w: x * w), F.lit(self.intercept), lambda s, x: s + x)


def grams(rows: DataFrame, features: str, label: str, block: str) -> dict[int, Gram]:
    """Moments of every block, from one scan; features is a vector column without missing values."""
    values = F.concat(vector_to_array(features), F.array(F.col(label).cast("double")))
    parts = pair_moments(rows.select(block, features, label), values, [block])
    found: dict[int, list] = {}
    for r in parts.orderBy("i").collect():  # features x features numbers for each block
        found.setdefault(r[block], []).append(r)
    out = {}
    for b, by in found.items():
        n = by[0]["n"][0]
        centre = np.array(by[0]["centre"])
        sums = np.array([r["own"][i] for i, r in enumerate(by)])
        cross = np.array([r["cross"] for r in by])
        out[b] = Gram(n, centre + sums / n, cross - np.outer(sums, sums) / n)
    return out


def expanding(blocks: dict[int, Gram], n_folds: int) -> list[tuple[int, Gram, Gram]]:
    """(fold, training, validation) moments; a fold without rows on either side is left out."""
    out, before = [], blocks.get(0)
    for k in range(1, n_folds + 1):
        held = blocks.get(k)
        if before is not None and held is not None:
            out.append((k, before, held))
        if held is not None:
            before = held if before is None else before.merge(held)
    return out


def alpha_errors(folded: DataFrame, alphas: Sequence[float], n_folds: int = 3, features: str = "features", label: str = "label") -> list[tuple[float, float | None]]:
    """(penalty, mean RMSE over the expanding folds) from one scan of rows with ``block``."""
    folds = expanding(grams(folded, features, label, "block"), n_folds)
    out = []
    for a in alphas:
        errors = [held.squared_error(train.solve(a)) ** 0.5 for _, train, held in folds]
        out.append((float(a), float(np.mean(errors)) if errors else None))
    return out


def fold_metrics(folded: DataFrame, alpha: float, n_folds: int = 3, features: str = "features", label: str = "label") -> DataFrame:
    """All metrics of every fold: one scan for the moments, one that scores each validation row with its
    fold's line."""
    folds = expanding(grams(folded, features, label, "block"), n_folds)
    scored = None
    for k, train, _ in folds:
        value = F.when(F.col("block") == k, train.solve(alpha).value(F.col("x__")))
        scored = value if scored is None else F.coalesce(scored, value)
    rows = folded.withColumn("x__", vector_to_array(features))
    rows = rows.withColumn("prediction", F.lit(None).cast("double") if scored is None else scored)
    held = rows.filter(F.col("block") > 0).withColumnRenamed("block", "fold")
    return compute_metrics(held, label, "prediction", ["fold"]).filter("n > 0")
