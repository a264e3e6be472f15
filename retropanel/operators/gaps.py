"""Gap handling inside ordered series.

Every window is keyed by a series and ordered by period after aggregation to one row per period, so
a partition is as long as the calendar, never as long as the raw table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from retropanel.functions.expr import percent_change


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _after(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.currentRow, Window.unboundedFollowing)


def interpolate(
    df: DataFrame, values: str | Sequence[str], series: Sequence[str], order: str, limit: int = 3
) -> DataFrame:
    """Linear interpolation by position, forward, at most ``limit`` cells per gap.

    Leading gaps stay NULL; a trailing gap repeats the last value up to the limit. All columns share
    one window, so they cost one sort.
    """
    names = [values] if isinstance(values, str) else list(values)
    w = Window.partitionBy(*series).orderBy(order)
    placed = df.withColumn("_pos", F.row_number().over(w))
    edges: dict[str, Column] = {}
    for c in names:
        cell = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_pos").alias("p")))
        edges[f"_b_{c}"] = F.last(cell, ignorenulls=True).over(_before(w))
        edges[f"_a_{c}"] = F.first(cell, ignorenulls=True).over(_after(w))
    filled: dict[str, Column] = {}
    for c in names:
        left, right = F.col(f"_b_{c}"), F.col(f"_a_{c}")
        step = F.col("_pos") - left["p"]
        line = left["v"] + (right["v"] - left["v"]) * step / (right["p"] - left["p"])
        filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(
            step <= limit, F.when(right.isNull(), left["v"]).otherwise(line)
        )
    return placed.withColumns(edges).withColumns(filled).drop("_pos", *edges)


def series_breaks(
    df: DataFrame, value: str, series: Sequence[str], order: str, threshold: float = 0.30
) -> DataFrame:
    """Rows whose change against the previous period exceeds the threshold in size."""
    w = Window.partitionBy(*series).orderBy(order)
    change = percent_change(F.col(value), F.lag(value).over(w)) / 100.0
    return df.withColumn("abs_change", F.abs(change)).filter(F.col("abs_change") > threshold)


def fill_both_ways(
    df: DataFrame, value: str, series: Sequence[str], order: str, default: Column | None = None
) -> DataFrame:
    """Carry forward, then backward, then take the default."""
    w = Window.partitionBy(*series).orderBy(order)
    chain = [
        F.last(value, ignorenulls=True).over(_before(w)),
        F.first(value, ignorenulls=True).over(_after(w)),
    ]
    if default is not None:
        chain.append(default)
    return df.withColumn(value, F.coalesce(*chain))


def fill_constants(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill(defaults)


def dense_calendar(
    df: DataFrame, months: DataFrame, entity: str = "dept", date_key: str = "date_id"
) -> DataFrame:
    """One row per entity and month, so that row lags become calendar lags.

    Each entity carries its own array of months (as long as the calendar) and explodes it.
    """
    span = months.agg(F.sort_array(F.collect_set(date_key)).alias("_all")).scalar()
    grid = df.select(entity).distinct().select(entity, F.explode(span).alias(date_key))
    return grid.join(df, [entity, date_key], "left")
