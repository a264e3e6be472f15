"""Regression metrics as aggregate expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.functions import expr as E


def metric_columns(actual: str, predicted: str) -> dict[str, Column]:
    """RMSE, MAE, MAPE over non-zero truth (x100) and R2; pairs with a NULL are left out."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    ok = y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)
    err = F.when(ok, y - p)
    truth = F.when(ok, y)
    n = F.count(truth)
    total = F.var_pop(truth) * n
    sse = F.sum(err * err)
    r2 = F.when(total > 0, 1.0 - sse / total).when(sse == 0, 1.0).when(sse > 0, 0.0)
    return {
        "n": n,
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.when(y != 0, F.abs(err / y))) * 100.0,
        "r2": r2,
    }


def compute_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    cols = [c.alias(n) for n, c in metric_columns(actual, predicted).items()]
    return df.groupBy(*keys).agg(*cols)


def compare_models(predictions: DataFrame, actual: str = "label") -> DataFrame:
    """Metrics per model and split side by side, best validation error first.

    ``predictions`` holds (model, split, label, prediction).
    """
    long = compute_metrics(predictions, actual, "prediction", ["model", "split"])
    cells = [
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
        for s in ("train", "val", "test")
        for m in ("rmse", "mae", "mape", "r2")
    ]
    return long.groupBy("model").agg(*cells).orderBy(F.col("val_rmse").asc_nulls_last(), "model")


def overfitting(comparison: DataFrame) -> DataFrame:
    """Relative R2 gaps between the splits and their band."""
    gap = lambda a, b: E.half_even(F.try_divide(F.col(a) - F.col(b), F.col(a)) * 100.0, 1)
    return comparison.select(
        "model",
        "train_r2",
        "val_r2",
        "test_r2",
        gap("train_r2", "val_r2").alias("train_val_gap_pct"),
        gap("val_r2", "test_r2").alias("val_test_gap_pct"),
    ).withColumn("verdict", E.gap_band("train_val_gap_pct"))


def residuals(predictions: DataFrame, actual: str = "label") -> DataFrame:
    return predictions.withColumn("residual", F.col(actual) - F.col("prediction"))


def grid_summary(results: DataFrame, keys: Sequence[str], value: str = "rmse") -> DataFrame:
    """Mean and deviation of a score over the other grid parameters."""
    return results.groupBy(*keys).agg(
        F.avg(value).alias(f"{value}_mean"), F.stddev_samp(value).alias(f"{value}_std")
    )


def best_row(table: DataFrame, metric: str, keep: Sequence[str]) -> DataFrame:
    """The row with the smallest metric; NULL and NaN never win."""
    ok = F.col(metric).isNotNull() & ~F.isnan(metric)
    best = F.min_by(F.struct(*keep, metric), F.struct(F.col(metric), *[F.col(k) for k in keep]))
    return table.filter(ok).agg(best.alias("b")).select("b.*")


def ranked(table: DataFrame, metric: str, higher_is_better: bool) -> DataFrame:
    order = F.col(metric).desc_nulls_last() if higher_is_better else F.col(metric).asc_nulls_last()
    return table.orderBy(order, "model")
