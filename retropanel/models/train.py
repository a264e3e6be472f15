"""Regressors on ``pyspark.ml``, their selection, attribution and per-entity models."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.models.metrics import compute_metrics
from retropanel.models.prepare import Prepared, expanding_folds
from retropanel.models.ridge import alpha_errors
from retropanel.models.search import Outcome, fold_parts, successive_halving

# Boosting parameters and per-entity regressors.
BOOSTING = {"maxDepth": 4, "stepSize": 0.05, "maxIter": 200, "subsamplingRate": 0.8, "minInstancesPerNode": 20}
REGRESSORS = ("temp_mean", "hdd_sum", "cdd_sum", "confiance_menages", "ipi_hvac_c28")
MIN_HISTORY = 12
# Candidate trend breaks lie in this share of the training months, so many of them, given enough months.
BREAKS, BREAK_SHARE, BREAK_HISTORY = 12, 0.8, 24


def fit_ridge(train: DataFrame, alpha: float, features: str = "features"):
    """Ridge with an unpenalised intercept.

    The library's penalty is per row and on the scale of the label's deviation, so the usual ``alpha``
    on the squared-error sum is converted with both.
    """
    n, spread = train.agg(F.count("label"), F.stddev_pop("label")).first()
    reg = alpha / n * spread if n else 0.0
    return LinearRegression(
        featuresCol=features,
        labelCol="label",
        solver="normal",
        elasticNetParam=0.0,
        standardization=False,
        regParam=float(reg or 0.0),
    ).fit(train)


def predictions(model, rows: DataFrame, name: str) -> DataFrame:
    """(date_id, dept, split, label, model, prediction) with negative counts cut to 0."""
    scored = model.transform(rows)
    return scored.select(
        "date_id",
        "dept",
        "split",
        "label",
        F.lit(name).alias("model"),
        E.non_negative("prediction").alias("prediction"),
    )


def cross_validate(folded: DataFrame, fit, n_folds: int = 3) -> DataFrame:
    """Fold scores of ``fit(train) -> model`` over expanding windows."""
    out = None
    for k in range(1, n_folds + 1):
        model = fit(folded.filter(F.col("block") < k))
        scored = model.transform(folded.filter(F.col("block") == k))
        row = compute_metrics(scored, "label", "prediction").withColumn("fold", F.lit(k))
        out = row if out is None else out.unionByName(row)
    return out


def cv_summary(folds: DataFrame) -> DataFrame:
    aggs = []
    for m in ("rmse", "mae", "mape", "r2"):
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return folds.agg(*aggs)


def ridge_alpha_scores(prep: Prepared, alphas: Sequence[float] = S.RIDGE_ALPHAS) -> DataFrame:
    """Mean fold error per alpha: one scan for the folds' moments, whatever the number of alphas."""
    folded = expanding_folds(prep.rows.filter("split = 'train'")).select("block", "label", "features")
    return prep.rows.sparkSession.createDataFrame(alpha_errors(folded, alphas), "alpha double, rmse double")


def select_alpha(scores: DataFrame) -> float:
    row = scores.filter(F.col("rmse").isNotNull()).orderBy("rmse", "alpha").first()
    return row["alpha"] if row else 1.0


def fit_boosting(rows: DataFrame, **params):
    """Gradient-boosted trees; validation rows stop the boosting early."""
    marked = rows.filter("split in ('train', 'val')").withColumn("_val", F.col("split") == "val")
    return GBTRegressor(
        featuresCol="raw",
        labelCol="label",
        seed=42,
        validationIndicatorCol="_val",
        validationTol=0.001,
        **{**BOOSTING, **params},
    ).fit(marked)


def boost(rows: DataFrame, setting: Mapping[str, float], rounds: int):
    """So many trees with a setting of the grid; the same rows and setting give the same trees."""
    return GBTRegressor(featuresCol="raw", labelCol="label", seed=42, **{**BOOSTING, **setting, "maxIter": rounds}).fit(rows)


# Depths, leaf sizes and steps of the full grid.
FULL_GRID = [
    {"maxDepth": d, "minInstancesPerNode": n, "stepSize": s}
    for d in (3, 4, 5, 6)
    for n in (10, 20, 50)
    for s in (0.01, 0.05, 0.1)
]


def boosting_search(prep: Prepared, grid: Sequence[Mapping[str, float]] = FULL_GRID, n_folds: int = 3, rounds: int = BOOSTING["maxIter"], parallelism: int = 8, least: int = 10) -> list[Outcome]:
    """The settings of a grid, best first: fits over stored expanding folds run side by side, and settings that
    fall behind are dropped before they cost all their trees."""
    folds = fold_parts(prep.rows.filter("split = 'train'"), ["label", "raw"], n_folds)
    return successive_halving(folds, grid, boost, rounds, parallelism=parallelism, least=least)


def importance(prep: Prepared, model) -> DataFrame:
    """Absolute coefficient or tree importance per feature."""
    raw = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(f, float(abs(v))) for f, v in zip(prep.features, raw.toArray())]
    return prep.rows.sparkSession.createDataFrame(rows, "feature string, importance double")


def linear_attribution(prep: Prepared, model) -> DataFrame:
    """Mean absolute contribution ``coef * (x - mean)`` of each scaled feature over all rows."""
    from pyspark.ml.functions import vector_to_array

    x = prep.rows.select(vector_to_array("features").alias("x"))
    means = x.agg(
        F.array(*[F.avg(F.col("x")[i]) for i in range(len(prep.features))]).alias("m")
    ).scalar()
    coef = [float(c) for c in model.coefficients]
    parts = x.withColumn("_m", means).agg(
        *[
            F.avg(F.abs(F.lit(c) * (F.col("x")[i] - F.col("_m")[i]))).alias(f"c{i}")
            for i, c in enumerate(coef)
        ]
    )
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("attribution"))
        for i, f in enumerate(prep.features)
    ]
    return parts.select(F.inline(F.array(*entries)))


def _month_number(date_id: pd.Series) -> np.ndarray:
    return (date_id // 100 * 12 + date_id % 100 - 1).to_numpy(dtype=float)


def seasonal_design(pdf: pd.DataFrame, regressors: Sequence[str], center: dict) -> np.ndarray:
    """Intercept, trend, what the slope changes by at each break, three yearly Fourier pairs and standardised
    regressors."""
    t = _month_number(pdf["date_id"])
    cols = [np.ones(len(t)), (t - center["t0"]) / 12.0]
    cols += [np.maximum(t - b, 0.0) / 12.0 for b in center["breaks"]]
    for k in (1, 2, 3):
        cols += [np.sin(2 * math.pi * k * t / 12), np.cos(2 * math.pi * k * t / 12)]
    for r in regressors:
        mean, scale = center[r]
        cols.append((pdf[r].to_numpy(dtype=float) - mean) / scale)
    return np.column_stack(cols)


def trend_breaks(months: np.ndarray) -> np.ndarray:
    """Where the trend may change: months evenly spread over the first part of the training span."""
    if len(months) < BREAK_HISTORY:
        return np.zeros(0)
    first, last = months.min(), months.max()
    return np.unique(np.round(np.linspace(first, first + BREAK_SHARE * (last - first), BREAKS + 2)[1:-1]))


def fit_seasonal(df: DataFrame, target: str, regressors: Sequence[str] = REGRESSORS, penalty: float = 1.0, stiffness: float = 1.0) -> DataFrame:
    """One additive model per department: a piecewise-linear trend, yearly season and regressors, by ridge
    least squares. The trend may bend at every break; ``stiffness`` is the penalty on each change of slope, so
    it bends where the months ask for it and is a straight line for a large one.

    ``df`` carries ``split``. A group is one department's months, so it stays as short as the calendar.
    Departments with fewer than twelve training months are skipped.
    """
    have = E.present(df, regressors)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date_id").reset_index(drop=True)
        train = pdf["split"] == "train"
        empty = pd.DataFrame(columns=["date_id", "dept", "split", "label", "model", "prediction"])
        if train.sum() < MIN_HISTORY:
            return empty
        for r in have:
            filled = pdf.groupby("split")[r].transform(lambda s: s.ffill().bfill())
            known = pdf.loc[train, r].dropna()
            pdf[r] = filled.fillna(known.median() if len(known) else 0.0)
        months = _month_number(pdf.loc[train, "date_id"])
        center = {"t0": months.mean(), "breaks": trend_breaks(months)}
        for r in have:
            center[r] = (pdf.loc[train, r].mean(), float(pdf.loc[train, r].std(ddof=0)) or 1.0)
        x, y = seasonal_design(pdf, have, center), pdf["label"].to_numpy(dtype=float)
        xt, yt = x[train.to_numpy()], y[train.to_numpy()]
        weight = np.full(x.shape[1], penalty)
        weight[0] = 0.0
        weight[2 : 2 + len(center["breaks"])] = stiffness
        beta = np.linalg.solve(xt.T @ xt + np.diag(weight) + 1e-9 * np.eye(x.shape[1]), xt.T @ yt)
        out = pdf[["date_id", "dept", "split", "label"]].copy()
        out["model"] = "seasonal"
        out["prediction"] = np.clip(x @ beta, 0, None)
        return out

    rows = df.filter(F.col(target).isNotNull()).select(
        "date_id",
        "dept",
        "split",
        F.col(target).cast("double").alias("label"),
        *[F.col(r).cast("double").alias(r) for r in have],
    )
    schema = "date_id int, dept string, split string, label double, model string, prediction double"
    return rows.groupBy("dept").applyInPandas(one, schema)
