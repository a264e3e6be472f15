"""Aggregations to the panel grain and reports over the panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E


def zero_sum(c: Column | str) -> Column:
    """Sum that is 0, not NULL, over nothing."""
    return F.coalesce(F.sum(c), F.lit(0))


def event_counts(df: DataFrame, period: str = "date_id", entity: str = "dept") -> DataFrame:
    """Events and flag sums per period and entity: partial sums on the map side, then one shuffle."""
    keyed = df.filter(F.col(period).isNotNull() & F.col(entity).isNotNull())
    return keyed.groupBy(period, entity).agg(
        F.count("is_pac").alias("nb_dpe_total"),
        zero_sum("is_pac").cast("bigint").alias("nb_installations_pac"),
        zero_sum("is_clim").cast("bigint").alias("nb_installations_clim"),
        zero_sum("is_classe_ab").cast("bigint").alias("nb_dpe_classe_ab"),
    )


def merge_counts(parts: Sequence[DataFrame], period: str = "date_id", entity: str = "dept") -> DataFrame:
    """Final aggregation over partial counts, such as one per ingested batch."""
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked.groupBy(period, entity).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in S.COUNT_COLUMNS]
    )


def ratio_columns(df: DataFrame) -> DataFrame:
    total = F.col("nb_dpe_total")
    return df.withColumns(
        {
            "pct_pac": E.percentage("nb_installations_pac", total),
            "pct_clim": E.percentage("nb_installations_clim", total),
            "pct_classe_ab": E.percentage("nb_dpe_classe_ab", total),
        }
    )


def monthly_weather(df: DataFrame, period: str = "date_id", entity: str = "dept") -> DataFrame:
    """Daily weather to monthly means, extremes, sums and day counts, for the columns present."""
    have = set(df.columns)
    plan: dict[str, Column] = {}
    for src, dst, fn in (
        ("temperature_2m_mean", "temp_mean", F.avg),
        ("temperature_2m_max", "temp_max", F.max),
        ("temperature_2m_min", "temp_min", F.min),
        ("precipitation_sum", "precipitation_sum", zero_sum),
        ("wind_speed_10m_max", "wind_max", F.max),
        ("hdd", "hdd_sum", zero_sum),
        ("cdd", "cdd_sum", zero_sum),
    ):
        if src in have:
            plan[dst] = E.half_even(fn(src), 2)
    if "temperature_2m_max" in have:
        plan["nb_jours_canicule"] = F.sum(E.above("temperature_2m_max", S.HEATWAVE_ABOVE))
    if "temperature_2m_min" in have:
        plan["nb_jours_gel"] = F.sum(E.below("temperature_2m_min", S.FROST_BELOW))
    if "pac_inefficient" in have:
        plan["nb_jours_pac_inefficient"] = zero_sum("pac_inefficient")
    elif "temperature_2m_min" in have:
        cold = E.below("temperature_2m_min", S.PUMP_INEFFICIENT_BELOW)
        plan["nb_jours_pac_inefficient"] = F.sum(cold)
    return df.groupBy(period, entity).agg(*[c.alias(n) for n, c in plan.items()])


def sum_measures(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    keyed = df
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    return keyed.groupBy(*keys).agg(*[zero_sum(m).alias(m) for m in measures])


def rate_columns(df: DataFrame, stock: str = "nb_logements_total") -> DataFrame:
    if stock not in df.columns:
        return df
    return df.withColumns(
        {
            "pac_per_1000_logements": E.per_thousand("nb_installations_pac", stock),
            "clim_per_1000_logements": E.per_thousand("nb_installations_clim", stock),
        }
    )


def flat_aggregate(df: DataFrame, keys: Sequence[str], plan: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several functions per column, named ``column_function``."""
    fns = {
        "sum": F.sum,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "median": F.median,
        "count": F.count,
    }
    aggs = [fns[f](c).alias(f"{c}_{f}") for c, names in plan.items() for f in names]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def region_totals(df: DataFrame, geo: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Entity totals first, then the region map, so the join sees one row per entity."""
    totals = df.groupBy("dept").agg(*[F.sum(m).alias(m) for m in measures])
    mapped = totals.join(F.broadcast(geo.select("dept", "region_code")), "dept")
    return mapped.groupBy("region_code").agg(
        F.count(F.lit(1)).alias("departments"), *[F.sum(m).alias(m) for m in measures]
    )


def seasonal_amplitude(df: DataFrame, columns: Sequence[str], min_rows: int = 100) -> DataFrame:
    """Deviation of monthly means over the overall mean, with peak and trough month, per column."""
    long = df.select("month", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ["month"], list(columns), "column", "value"
    )
    monthly = long.groupBy("column", "month").agg(
        F.sum("value").alias("s"), F.count("value").alias("n"), F.avg("value").alias("m")
    )
    return (
        monthly.groupBy("column")
        .agg(
            F.sum("n").alias("n"),
            (F.sum("s") / F.sum("n")).alias("overall"),
            F.stddev_samp("m").alias("spread"),
            F.max_by("month", F.struct("m", -F.col("month"))).alias("peak_month"),
            F.min_by("month", F.struct("m", "month")).alias("trough_month"),
        )
        .filter((F.col("n") >= min_rows) & (F.abs("overall") > 0.01))
        .select(
            "column",
            E.half_even(F.col("spread") / F.abs("overall"), 4).alias("seasonal_cv"),
            "peak_month",
            "trough_month",
        )
    )


def overview(df: DataFrame) -> DataFrame:
    """One row of dataset metrics."""
    cells = F.lit(0)
    for c in df.columns:
        cells = cells + F.col(c).isNull().cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        E.half_even(F.sum(cells) * 100.0 / (F.count(F.lit(1)) * len(df.columns)), 2).alias("nan_pct"),
        F.countDistinct("dept").alias("n_departments"),
        F.countDistinct("date_id").alias("n_months"),
        F.min("date_id").alias("first_month"),
        F.max("date_id").alias("last_month"),
        F.sum("nb_dpe_total").alias("total_dpe"),
        F.sum("nb_installations_pac").alias("total_pac"),
        E.half_even(
            F.try_divide(F.sum("nb_installations_pac") * 100.0, F.sum("nb_dpe_total")), 2
        ).alias("pct_pac_global"),
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed."""
    x = F.col(value).cast("double")
    bounds = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("b")).scalar()
    framed = df.filter(x.isNotNull()).select(x.alias("v")).withColumn("_b", bounds)
    width = (F.col("_b.hi") - F.col("_b.lo")) / F.lit(float(bins))
    bucket = F.least(F.floor(F.try_divide(F.col("v") - F.col("_b.lo"), width)), F.lit(bins - 1))
    return framed.groupBy(F.coalesce(bucket, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def market_share(df: DataFrame, year: str = "year", entity: str = "dept_name") -> DataFrame:
    """Ratio of sums per year and entity, and the share of the year's total."""
    from pyspark.sql import Window

    sums = df.filter(F.col("nb_dpe_total").isNotNull()).groupBy(year, entity).agg(
        F.sum("nb_installations_pac").alias("total_pac"),
        F.sum("nb_dpe_total").alias("total_dpe"),
        F.sum("nb_installations_clim").alias("total_clim"),
    )
    pct = lambda a, b: E.half_even(F.try_divide(F.col(a) * 100.0, b), 2)
    yearly = F.sum("total_pac").over(Window.partitionBy(year))
    return sums.select(
        year,
        entity,
        "total_pac",
        "total_dpe",
        pct("total_pac", F.col("total_dpe")).alias("part_pac_pct"),
        pct("total_clim", F.col("total_dpe")).alias("part_clim_pct"),
        pct("total_pac", yearly).alias("part_pac_year_pct"),
    )


def error_aggregates(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    r = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.avg(F.abs(r)).alias("mae"),
        F.avg(r).alias("mean_bias"),
        F.stddev_samp(r).alias("residual_std"),
        F.avg(actual).alias("actual_mean"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


def file_summary(df: DataFrame) -> DataFrame:
    """Rows, size and modification time per source file."""
    meta = F.col("_metadata")
    return df.groupBy(
        meta["file_name"].alias("file_name"),
        meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("modified"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


def trend_kpis(recent: DataFrame, value: str, entity: str = "dept") -> DataFrame:
    """Last value, change, and mean of the last six against the six before (``recency`` 1 is last)."""
    r, v = F.col("recency"), F.col(value)
    last = F.max(F.when(r == 1, v))
    prev = F.max(F.when(r == 2, v))
    now, before = F.avg(F.when(r <= 6, v)), F.avg(F.when(r.between(7, 12), v))
    return recent.groupBy(entity).agg(
        last.alias("last_value"),
        (last - F.coalesce(prev, last)).alias("delta"),
        E.half_even(
            F.when(F.count(F.lit(1)) >= 12, F.when(before > 0, (now - before) / before * 100).otherwise(0.0)),
            4,
        ).alias("trend_pct"),
    )


def completeness(df: DataFrame, exclude: Sequence[str] = S.NON_FEATURES) -> DataFrame:
    """Number and share of non-null features per row."""
    names = [c for c in df.columns if c not in exclude]
    n = F.lit(0)
    for c in names:
        n = n + F.col(c).isNotNull().cast("int")
    return df.withColumns(
        {
            "n_valid_features": n,
            "pct_valid_features": E.half_even(n * F.lit(100.0) / F.lit(len(names)), 1),
        }
    )
