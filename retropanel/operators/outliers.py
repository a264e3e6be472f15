"""Outlier detection by three methods, voting and treatment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.operators import iforest
from retropanel.operators.quantiles import exact_quantiles
from retropanel.operators.reshape import unpivot_values
from retropanel.session import materialize

# Factors and the columns never analysed.
IQR_FACTOR = 1.5
ZSCORE_FACTOR = 0.6745
ZSCORE_LIMIT = 3.5
CONTAMINATION = 0.05
MIN_VALUES = 4
NOT_ANALYSED = ("date_id", "year", "month", "quarter", "n_valid_features", "pct_valid_features")


def analysed_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return E.numeric_columns(df, [*NOT_ANALYSED, *exclude])


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact quartiles per column, worked out once for whoever reads them; as many rows as columns."""
    found = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR, known: DataFrame | None = None) -> DataFrame:
    """Tukey fences per column, for columns with enough values; ``known`` are the quartiles if at hand."""
    q = (known or exact_quantiles(df, columns, (0.25, 0.75))).filter(F.col("n") >= MIN_VALUES)
    iqr = F.col("q75") - F.col("q25")
    return q.select(
        "column",
        "n",
        (F.col("q25") - factor * iqr).alias("lower"),
        (F.col("q75") + factor * iqr).alias("upper"),
    )


def mad_scale(df: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Median and median absolute deviation per column; columns without spread are left out."""
    med = (known or exact_quantiles(df, columns, (0.5,))).filter(F.col("n") >= MIN_VALUES)
    med = med.select("column", "n", F.col("q50").alias("median"))
    center = fitted(med)
    names = [c for c in columns if c in center]
    if not names:
        return med.withColumn("mad", F.lit(None).cast("double")).filter("mad > 0")
    gaps = df.select(
        *[F.abs(F.col(c).cast("double") - F.lit(center[c]["median"])).alias(c) for c in names]
    )
    mad = exact_quantiles(gaps, names, (0.5,)).select("column", F.col("q50").alias("mad"))
    known = df.sparkSession.createDataFrame(
        [(c, center[c]["n"], center[c]["median"]) for c in names], "column string, n bigint, median double"
    )
    return known.join(mad, "column").filter(F.col("mad") > 0)


def fitted(parameters: DataFrame) -> dict[str, Row]:
    """Per-column parameters on the driver: as many rows as the table has analysed columns."""
    return {r["column"]: r for r in parameters.collect()}


def iqr_flags(bounds: Mapping[str, Row]) -> dict[str, Column]:
    out = {}
    for c, b in bounds.items():
        x = F.col(c).cast("double")
        out[c] = F.coalesce((x < F.lit(b["lower"])) | (x > F.lit(b["upper"])), F.lit(False))
    return out


def zscore_flags(scale: Mapping[str, Row], limit: float = ZSCORE_LIMIT) -> dict[str, Column]:
    out = {}
    for c, s in scale.items():
        z = F.lit(ZSCORE_FACTOR) * (F.col(c).cast("double") - F.lit(s["median"])) / F.lit(s["mad"])
        out[c] = F.coalesce(F.abs(z) > limit, F.lit(False))
    return out


def _any(flags: dict[str, Column]) -> Column:
    hit = F.lit(False)
    for f in flags.values():
        hit = hit | f
    return hit


def iqr_report(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Outlier count, share and fences of each column that has any."""
    bounds = iqr_bounds(df, columns, factor)
    long = unpivot_values(df, [], columns, "column", "value").join(F.broadcast(bounds), "column")
    hit = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return (
        long.groupBy("column", "n", "lower", "upper")
        .agg(F.count_if(hit).alias("n_outliers"))
        .filter(F.col("n_outliers") > 0)
        .select(
            "column",
            "n_outliers",
            E.half_even(F.col("n_outliers") * 100.0 / F.col("n"), 2).alias("pct"),
            E.half_even("lower", 4).alias("lower_bound"),
            E.half_even("upper", 4).alias("upper_bound"),
        )
    )


def zscore_report(df: DataFrame, columns: Sequence[str], limit: float = ZSCORE_LIMIT) -> DataFrame:
    scale = mad_scale(df, columns)
    long = unpivot_values(df, [], columns, "column", "value").join(F.broadcast(scale), "column")
    z = F.lit(ZSCORE_FACTOR) * (F.col("value") - F.col("median")) / F.col("mad")
    return (
        long.groupBy("column", "n", "median", "mad")
        .agg(F.count_if(F.abs(z) > limit).alias("n_outliers"))
        .filter(F.col("n_outliers") > 0)
        .select(
            "column",
            "n_outliers",
            E.half_even(F.col("n_outliers") * 100.0 / F.col("n"), 2).alias("pct"),
            "median",
            "mad",
        )
    )


def flag_univariate(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Row flags: outside the fences, or beyond the robust z-limit, on any column."""
    known = quartiles(df, columns)
    bounds = fitted(iqr_bounds(df, columns, factor, known))
    scale = fitted(mad_scale(df, columns, known))
    return df.withColumns(
        {"_outlier_iqr": _any(iqr_flags(bounds)), "_outlier_zscore": _any(zscore_flags(scale))}
    )


def vote(df: DataFrame, methods: Sequence[str]) -> DataFrame:
    score = F.lit(0)
    for m in methods:
        score = score + F.col(m).cast("int")
    return df.withColumns({"_outlier_score": score, "_outlier_consensus": score >= 2})


def detect_and_flag(
    df: DataFrame,
    row_id: Sequence[str],
    columns: Sequence[str] | None = None,
    contamination: float = CONTAMINATION,
    seed: int = 42,
) -> DataFrame:
    """Flags of the three methods, number of votes and consensus (two or more)."""
    names = list(columns) if columns else analysed_columns(df)
    flagged = flag_univariate(df, names)
    if len(names) >= 2 and df.limit(10).count() == 10:
        scored = materialize(iforest.score(flagged, names, row_id, seed))
        flagged = scored.withColumn(
            "_outlier_iforest", iforest.flag_isolated(scored, contamination)
        ).drop("anomaly_score")
    else:
        flagged = flagged.withColumn("_outlier_iforest", F.lit(False))
    return vote(flagged, ["_outlier_iqr", "_outlier_zscore", "_outlier_iforest"])


def winsorize(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    factor: float = IQR_FACTOR,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Bring values outside the fences back to them."""
    names = list(columns) if columns else analysed_columns(df, exclude)
    out = {}
    for c, b in fitted(iqr_bounds(df, names, factor)).items():
        out[c] = E.clip(F.col(c).cast("double"), F.lit(b["lower"]), F.lit(b["upper"]))
    return df.withColumns(out)


def winsorize_report(df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    report = iqr_report(df, columns, factor)
    return report.select("column", F.col("n_outliers").alias("n_clipped"), "lower_bound", "upper_bound")


def remove_outliers(df: DataFrame, use_consensus: bool = True) -> DataFrame:
    flag = "_outlier_consensus" if use_consensus else "_outlier_iqr"
    return df.filter(~F.col(flag))


def treat(flagged: DataFrame, strategy: str, columns: Sequence[str] | None = None, use_consensus: bool = True) -> DataFrame:
    """``flag`` keeps the flags only, ``clip`` winsorises, ``remove`` drops the voted rows."""
    if strategy == "clip":
        return winsorize(flagged, columns)
    if strategy == "remove":
        return remove_outliers(flagged, use_consensus)
    return flagged


def vote_summary(flagged: DataFrame) -> DataFrame:
    """Rows per method and consensus, with their share."""
    methods = ["_outlier_iqr", "_outlier_zscore", "_outlier_iforest", "_outlier_consensus"]
    have = [m for m in methods if m in flagged.columns]
    counts = flagged.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(m).alias(m) for m in have])
    return counts.unpivot(["n_rows"], have, "method", "n_outliers").withColumn(
        "pct", E.half_even(F.try_divide(F.col("n_outliers") * 100.0, F.col("n_rows")), 2)
    )
