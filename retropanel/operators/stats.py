"""Profiles and correlations. Wide tables are handled column-wise in one aggregation per report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.operators.moments import SUMS, pair_moments
from retropanel.operators.quantiles import attach_ranks, exact_quantiles
from retropanel.operators.reshape import unpivot_all, unpivot_values


def _pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    x, y = E.col(a).cast("double"), E.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over pairs without NULL; NULL where one side does not vary.

    The built-in ``corr`` divides by zero on a constant side, which is an error under ANSI mode.
    """
    x, y = _pair(a, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _rows(df: DataFrame, keys: Sequence[str], cells: Mapping[str, Column], value: str) -> DataFrame:
    """Aggregate many cells at once, then one row per cell."""
    wide = df.groupBy(*keys).agg(*[c.alias(f"c{i}") for i, c in enumerate(cells.values())])
    entries = [
        F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias(value)) for i, n in enumerate(cells)
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, exact quartiles, null share and type per column."""
    types = dict(df.dtypes)
    kind = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    long = unpivot_all(df, [], columns, "column", "value")
    base = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        E.half_even(F.count_if(F.col("value").isNull()) * 100.0 / F.count(F.lit(1)), 1).alias("pct_nan"),
    )
    quart = exact_quantiles(df, columns, (0.25, 0.5, 0.75)).drop("n")
    return base.join(quart, "column", "left").withColumn("dtype", kind[F.col("column")])


def null_report(df: DataFrame) -> DataFrame:
    """Null count, share, type and severity of every column from one aggregation."""
    types = dict(df.dtypes)
    kind = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    cells = {c: F.struct(F.count_if(F.col(c).isNull()).alias("k"), F.count(F.lit(1)).alias("n")) for c in df.columns}
    rows = _rows(df, [], cells, "v")
    pct = E.half_even(F.try_divide(F.col("v.k") * 100.0, F.col("v.n")), 2)
    return rows.select(
        F.col("name").alias("column"),
        F.col("v.k").alias("null_count"),
        pct.alias("null_pct"),
        kind[F.col("name")].alias("dtype"),
    ).withColumn("severity", E.severity_band("null_pct"))


#: Columns up to which pairs are aggregates side by side; wider tables go through cross products.
WIDE_MATRIX = 12


def correlation_pairs(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Lower triangle of the correlation matrix in long form: one pass, no shuffle of rows."""
    if len(columns) > WIDE_MATRIX and not keys:
        return _wide_correlations(df, list(columns))
    cells = {f"{a}|{b}": safe_corr(a, b) for a, b in combinations(columns, 2)}
    rows = _rows(df, keys, cells, "r")
    parts = F.split("name", r"\|")
    return rows.select(*keys, parts[0].alias("a"), parts[1].alias("b"), "r")


def _wide_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlations of many columns from the moments of all pairs, gathered in one scan.

    A side varies if its spread is more than what rounding leaves of equal values.
    """
    sums = pair_moments(df, F.array(*[F.col(c).cast("double") for c in columns]))
    each = F.arrays_zip("centre", *SUMS)
    pairs = sums.select("i", "centre_i", F.posexplode(each).alias("j", "m")).filter("j > i").select("i", "j", "centre_i", "m.*")
    n = F.col("n")
    cov = F.col("cross") - F.try_divide(F.col("own") * F.col("other"), n)
    spread = {v: F.col(f"{v}2") - F.try_divide(F.col(v) * F.col(v), n) for v in ("own", "other")}
    least = {v: F.greatest(F.col(f"{v}2") * 1e-13, n * F.pow(F.nanvl(F.col(c), F.lit(0.0)) * 1e-15, 2)) for v, c in (("own", "centre_i"), ("other", "centre"))}
    varies = (spread["own"] > least["own"]) & (spread["other"] > least["other"])
    names = F.array(*map(F.lit, columns))
    r = F.when(varies, cov / F.sqrt(spread["own"] * spread["other"]))
    return pairs.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), r.alias("r"))


def target_correlations(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    keys: Sequence[str] = (),
    min_rows: int | None = None,
) -> DataFrame:
    """Correlation of each column with the target, per group if asked; small groups are left out."""
    cells = {c: safe_corr(c, target) for c in columns if c != target}
    if min_rows is None:
        rows = _rows(df, keys, cells, "r")
    else:
        cells = {n: F.struct(c.alias("r"), F.count(F.lit(1)).alias("n")) for n, c in cells.items()}
        rows = _rows(df, keys, cells, "v").filter(F.col("v.n") > min_rows)
        rows = rows.select(*keys, "name", F.col("v.r").alias("r"))
    return rows.withColumnRenamed("name", "feature")


def strongest(corr: DataFrame, n: int) -> DataFrame:
    """Top n by size of the correlation, sign kept."""
    return corr.filter(F.col("r").isNotNull()).orderBy(F.abs("r").desc(), "feature").limit(n)


def collinear_pairs(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    return pairs.filter(F.abs("r") > threshold)


def keep_drop_advice(pairs: DataFrame) -> DataFrame:
    """Greedy advice over the collinear pairs, strongest first.

    Input rows are column pairs of one table's schema, so the list is as short as the schema allows.
    """
    ordered = pairs.orderBy(F.abs("r").desc(), "a", "b").collect()
    dropped: set[str] = set()
    advice = []
    for row in ordered:
        if row["a"] not in dropped and row["b"] not in dropped:
            advice.append((row["a"], row["b"], row["r"]))
            dropped.add(row["b"])
    return pairs.sparkSession.createDataFrame(advice, "keep string, drop string, r double")


def lag_correlations(df: DataFrame, variables: Sequence[str], lags: Sequence[int], target: str) -> DataFrame:
    """Correlation of each lag column with the target: variable by horizon."""
    cells = {
        f"{v}|{k}": safe_corr(f"{v}_lag_{k}m", target)
        for v in variables
        for k in lags
        if f"{v}_lag_{k}m" in df.columns
    }
    parts = F.split("name", r"\|")
    long = _rows(df, [], cells, "r").select(parts[0].alias("variable"), parts[1].cast("int").alias("k"), "r")
    return long.groupBy("variable").agg(
        *[F.max(F.when(F.col("k") == k, F.col("r"))).alias(f"lag_{k}m") for k in lags]
    )


def spearman(df: DataFrame, columns: Sequence[str], target: str, min_rows: int = 100) -> DataFrame:
    """Rank correlation with average ranks over complete pairs.

    The rows are sorted once by the target, which gets a rank among the pairs of each column. Its ranks are summed
    up by (column, x), so the values of x get theirs, and the sums of products come from one row a value.
    """
    ids = range(len(columns))
    xs, ws, rs = ([f"{k}{i}" for i in ids] for k in "xwr")
    wide = df.filter(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("y"), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, xs)])
    wide = wide.filter(F.coalesce(*xs).isNotNull()).withColumns({w: F.col(x).isNotNull().cast("int") for w, x in zip(ws, xs)})
    cells = [F.struct(F.lit(c).alias("column"), F.col(x).alias("x"), F.col(r).alias("ry")) for c, x, r in zip(columns, xs, rs)]
    pairs = attach_ranks(wide, None, "y", ws, rs, centred=True).select(F.inline(F.array(*cells))).filter(F.col("x").isNotNull())
    values = pairs.groupBy("column", "x").agg(F.count(F.lit(1)).alias("w"), F.sum("ry").alias("sy"), F.sum(F.col("ry") * F.col("ry")).alias("syy"))
    rx, n = F.col("rx"), F.sum("w")
    spread = F.sqrt(F.sum(F.col("w") * rx * rx)) * F.sqrt(F.sum("syy"))
    return attach_ranks(values, "column", "x", "w", "rx", centred=True).groupBy("column").agg(
        n.alias("n"), F.try_divide(F.sum(rx * F.col("sy")), spread).alias("rho")
    ).filter(F.col("n") >= min_rows)


def linear_fits(df: DataFrame, features: Sequence[str], target: str, min_rows: int = 10) -> DataFrame:
    """Slope, intercept and correlation of the target on each feature."""
    cells = {}
    for f in features:
        x, y = _pair(f, target)
        slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
        cells[f] = F.struct(
            F.count(x).alias("n"),
            slope.alias("slope"),
            (F.avg(y) - slope * F.avg(x)).alias("intercept"),
            safe_corr(f, target).alias("r"),
        )
    rows = _rows(df, [], cells, "v").select(F.col("name").alias("feature"), "v.*")
    return rows.filter(F.col("n") > min_rows)


def feature_screen(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Null share, correlation with the target and basic statistics of candidate features."""
    cells = {
        f: F.struct(
            (F.count_if(F.col(f).isNull()) * 100.0 / F.count(F.lit(1))).alias("null_pct"),
            safe_corr(f, target).alias("r"),
            F.avg(f).alias("mean"),
            F.stddev_samp(f).alias("std"),
            F.min(F.col(f).cast("double")).alias("min"),
            F.max(F.col(f).cast("double")).alias("max"),
        )
        for f in features
    }
    return _rows(df, [], cells, "v").select(F.col("name").alias("feature"), "v.*")
