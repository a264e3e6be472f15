"""Pivot and unpivot with known column sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_first(
    df: DataFrame,
    index: Sequence[str],
    code: str,
    value: str,
    names: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """Wide table of the first non-null value per cell; ``order`` decides which one is first.

    The cell values are conditional aggregates over a known code list: no extra job to find codes.
    """
    rank = F.struct(*order)
    cells = [
        F.min_by(F.col(value), F.when((F.col(code) == k) & F.col(value).isNotNull(), rank)).alias(v)
        for k, v in names.items()
    ]
    return df.groupBy(*index).agg(*cells)


def pivot_mean(
    df: DataFrame, index: Sequence[str], code: str, value: str, codes: Sequence, prefix: str
) -> DataFrame:
    cells = [F.avg(F.when(F.col(code) == k, F.col(value))).alias(f"{prefix}{k}") for k in codes]
    return df.groupBy(*index).agg(*cells)


def unpivot_values(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Long rows of the non-null cells."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def unpivot_all(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), name, value)
