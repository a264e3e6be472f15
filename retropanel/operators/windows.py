"""Series windows: one specification per (entity, order), so Spark sorts and shuffles once.

All of them run after aggregation to one row per entity and period.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from retropanel.functions import expr as E


def by_entity(entity: str = "dept", order: str = "date_id") -> WindowSpec:
    return Window.partitionBy(entity).orderBy(order)


def last_k(w: WindowSpec, k: int, shift: bool = False) -> WindowSpec:
    """The current row and the k-1 before it, or the k rows before it."""
    return w.rowsBetween(-k, -1) if shift else w.rowsBetween(-(k - 1), 0)


def lag_columns(cols: Sequence[str], lags: Sequence[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{c}_lag_{k}m": F.lag(c, k).over(w) for c in cols for k in lags}


def rolling_means(
    cols: Sequence[str], sizes: Sequence[int], w: WindowSpec, shift: bool = False
) -> dict[str, Column]:
    return {
        f"{c}_rmean_{k}m": E.half_even(F.avg(c).over(last_k(w, k, shift)), 2)
        for c in cols
        for k in sizes
    }


def rolling_stds(
    cols: Sequence[str], sizes: Sequence[int], w: WindowSpec, shift: bool = False
) -> dict[str, Column]:
    """Sample deviation; a single row gives NULL."""
    return {
        f"{c}_rstd_{k}m": E.half_even(F.stddev_samp(c).over(last_k(w, k, shift)), 2)
        for c in cols
        for k in sizes
    }


def _carried(c: str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def _carried_before(c: str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))


def differences(cols: Sequence[str], w: WindowSpec, shift: bool = False) -> dict[str, Column]:
    if shift:
        return {f"{c}_diff_1m": F.lag(c, 1).over(w) - F.lag(c, 2).over(w) for c in cols}
    return {f"{c}_diff_1m": F.col(c) - F.lag(c, 1).over(w) for c in cols}


def change_pct(c: str, w: WindowSpec) -> Column:
    """Percent change on the forward-filled series."""
    return E.percent_change(_carried(c, w), _carried_before(c, w))


def pct_changes(cols: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    return {
        f"{c}_pct_1m": E.clip(E.half_even(change_pct(c, w), 2), -200.0, 500.0) for c in cols
    }


def deviation_from_group(df: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn(name, E.half_even(F.col(value) - mean, 2))


def rank_in_period(df: DataFrame, value: str, period: str = "date_id", name: str = "rank") -> DataFrame:
    """Competition rank of entities inside each period."""
    w = Window.partitionBy(period).orderBy(F.col(value).desc())
    return df.withColumn(name, F.rank().over(w))


def metric_ranks(df: DataFrame, entity: str, metrics: Sequence[str]) -> DataFrame:
    """Rank of every entity on every metric, keyed by metric: one partition per metric."""
    long = df.select(entity, *metrics).unpivot([entity], list(metrics), "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.col("value").desc())
    ranked = long.withColumn("rank", F.rank().over(w))
    wide = ranked.groupBy(entity).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("rank"))).alias(f"rank_{m}") for m in metrics]
    )
    return df.join(wide, entity)


def year_over_year(df: DataFrame, value: str, w: WindowSpec) -> DataFrame:
    before = F.lag(value, 12).over(w)
    change = F.try_divide(F.col(value) - before, before) * 100
    return df.withColumns({"previous_year": before, "yoy_pct": E.half_even(change, 1)})


def temporal_anomalies(
    df: DataFrame, value: str, entity: str = "dept", order: str = "date_id", threshold: float = 50.0
) -> DataFrame:
    """Months that move more than the threshold against the month before; growth from zero counts."""
    w = by_entity(entity, order)
    return (
        df.select(entity, order, F.col(value).cast("double").alias("value"))
        .withColumn("pct_change", change_pct("value", w))
        .filter(F.abs("pct_change") > threshold)
        .withColumns(
            {
                "pct_change": E.half_even("pct_change", 1),
                "type": F.when(F.col("pct_change") > 0, "spike").otherwise("drop"),
            }
        )
    )


def global_scalars(df: DataFrame, aggregates: Mapping[str, Column]) -> Column:
    """One struct of whole-table aggregates as a scalar subquery: no join, no single-partition window."""
    names = list(aggregates)
    packed = df.agg(*[aggregates[n].alias(n) for n in names]).select(F.struct(*names).alias("s"))
    return packed.scalar()


def cumulative_share(df: DataFrame, value: str, group: str, tiebreak: str) -> DataFrame:
    """Share reached by the sorted values of each group, with their rank."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), tiebreak)
    total = F.sum(value).over(Window.partitionBy(group))
    upto = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"rank": F.row_number().over(w), "cum_pct": F.try_divide(upto * 100.0, total)})


def first_reaching(df: DataFrame, group: str, shares: Sequence[float]) -> DataFrame:
    """Rank at which the cumulative share reaches each mark."""
    return df.groupBy(group).agg(
        *[
            F.min(F.when(F.col("cum_pct") >= s, F.col("rank"))).alias(f"rank_at_{int(s)}")
            for s in shares
        ]
    )


def display_rank(df: DataFrame, value: str, group: str, tiebreak: str, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), tiebreak)
    return df.withColumn(name, F.row_number().over(w))


def lookback_sequences(
    df: DataFrame, features: Sequence[str], target: str, k: int, w: WindowSpec
) -> DataFrame:
    """The k feature vectors before each row of the same entity; rows with fewer are left out."""
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return (
        df.withColumns(
            {
                "sequence": F.collect_list(vector).over(w.rowsBetween(-k, -1)),
                "label": F.coalesce(F.col(target).cast("double"), F.lit(0.0)),
            }
        )
        .filter(F.size("sequence") == k)
    )


def month_gaps(months: DataFrame, keys: Sequence[str] = (), date_key: str = "date_id") -> DataFrame:
    """Consecutive periods of a series that are not consecutive months.

    ``months`` holds distinct periods per key: at most one row per calendar month.
    """
    series = list(keys) or ["_all"]
    framed = months if keys else months.withColumn("_all", F.lit(1))
    w = Window.partitionBy(*series).orderBy(date_key)
    return (
        framed.withColumn("next_id", F.lead(date_key).over(w))
        .filter(F.col("next_id") != E.shift_month(date_key, 1))
        .select(*keys, F.col(date_key).alias("gap_after"), F.col("next_id").alias("gap_before"))
    )


def last_rows(df: DataFrame, entity: str, order: str, n: int) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(F.col(order).desc())
    return df.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)
