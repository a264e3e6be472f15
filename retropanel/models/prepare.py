"""Splits, feature selection, imputation and scaling for the regressors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel import settings as S
from retropanel.operators.quantiles import exact_quantiles

# Columns never used as inputs, targets, and name parts of target-derived inputs.
EXCLUDED = (
    "date_id",
    "dept",
    "dept_name",
    "city_ref",
    "latitude",
    "longitude",
    "n_valid_features",
    "pct_valid_features",
    "pct_pac",
    "pct_clim",
    "pct_classe_ab",
)
OUTLIER_FLAGS = ("_outlier_iqr", "_outlier_zscore", "_outlier_iforest", "_outlier_consensus", "_outlier_score")
TARGETS = (*S.COUNT_COLUMNS, *S.RATE_COLUMNS)
TARGET_PARTS = ("_lag_", "_rmean_", "_rstd_", "_diff_", "_pct_")


def temporal_split(df: DataFrame, train_end: int, val_end: int) -> DataFrame:
    """Add ``split``: everything up to the first month trains, then validation, then test."""
    d = F.col("date_id")
    return df.withColumn(
        "split", F.when(d <= train_end, "train").when(d <= val_end, "val").otherwise("test")
    )


def select_features(df: DataFrame, target: str, without_target_lags: bool = False) -> list[str]:
    """Numeric inputs: no identifiers, other targets, leaking ratios or outlier flags."""
    drop = {*EXCLUDED, *TARGETS, target, "split"}
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and f.name not in drop
        and not any(p in f.name for p in OUTLIER_FLAGS)
    ]
    if without_target_lags:
        names = [
            n for n in names if not (n.startswith(target) and any(p in n for p in TARGET_PARTS))
        ]
    return names


def non_empty(train: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with at least one value in the training rows (one row of counts)."""
    counts = train.agg(*[F.count(c).alias(c) for c in features]).first()
    return [c for c in features if counts[c] > 0]


def train_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact training medians: one number per feature."""
    rows = exact_quantiles(train, features, (0.5,)).select("column", "q50").collect()
    return {r["column"]: r["q50"] for r in rows}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    )


@dataclass(frozen=True)
class RobustScale:
    """Median and interquartile range per feature; a feature without range becomes 0."""

    median: tuple[float, ...]
    range: tuple[float, ...]

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str]) -> RobustScale:
        """Exact interpolated quartiles of the training rows: one row per feature."""
        found = {r["column"]: r for r in exact_quantiles(train, features, (0.25, 0.5, 0.75)).collect()}
        return cls(
            tuple(found[f]["q50"] if f in found else 0.0 for f in features),
            tuple(found[f]["q75"] - found[f]["q25"] if f in found else 0.0 for f in features),
        )

    def columns(self, features: Sequence[str]) -> dict[str, Column]:
        return {
            f"_scaled{i}": (F.col(c).cast("double") - F.lit(m)) / F.lit(r) if r else F.lit(0.0)
            for i, (c, m, r) in enumerate(zip(features, self.median, self.range))
        }


@dataclass(frozen=True)
class Prepared:
    """Split rows with an imputed and a scaled vector, and what was fitted on training rows."""

    rows: DataFrame
    features: list[str]
    medians: dict[str, float]
    scaler: RobustScale

    def transform(self, df: DataFrame) -> DataFrame:
        return vectors(impute(df, self.medians), self.features, self.scaler)


def vectors(filled: DataFrame, features: list[str], scaler: RobustScale) -> DataFrame:
    """Add ``raw`` and ``features``, the inputs as they are and scaled."""
    scaled = scaler.columns(features)
    both = VectorAssembler(inputCols=features, outputCol="raw").transform(filled).withColumns(scaled)
    return VectorAssembler(inputCols=list(scaled), outputCol="features").transform(both).drop(*scaled)


def prepare(
    df: DataFrame, target: str, train_end: int, val_end: int, without_target_lags: bool = False
) -> Prepared:
    """Fit imputation and robust scaling on the training split only; apply to all."""
    split = temporal_split(df, train_end, val_end).filter(F.col(target).isNotNull())
    train = split.filter("split = 'train'")
    features = non_empty(train, select_features(split, target, without_target_lags))
    medians = train_medians(train, features)
    filled = impute(split, medians)
    scaler = RobustScale.fit(filled.filter("split = 'train'"), features)
    rows = vectors(filled, features, scaler).withColumn("label", F.col(target).cast("double"))
    return Prepared(rows, features, medians, scaler)


def expanding_folds(train: DataFrame, n_folds: int = 3, order: str = "date_id") -> DataFrame:
    """Add ``block`` 0..n: fold k trains on blocks up to k-1 and validates on block k.

    Blocks are cut by cumulative row counts per period, so one month is never split between folds and
    the window runs over months only.
    """
    months = train.groupBy(order).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(F.lit(0)).orderBy(order)  # one row per calendar month
    upto = F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("c").over(Window.partitionBy(F.lit(0)))
    cut = months.select(
        order,
        F.least(
            F.floor(F.coalesce(upto, F.lit(0)) * (n_folds + 1) / total), F.lit(n_folds)
        ).cast("int").alias("block"),
    )
    return train.join(cut, order)
