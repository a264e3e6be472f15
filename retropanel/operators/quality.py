"""Data quality: coverage, freshness, validation checks, gates, constraints and lineage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.operators.stats import _rows, null_report
from retropanel.operators.windows import month_gaps

# Which column name fragments belong to which source, in order of precedence.
SOURCE_PATTERNS = {
    "Weather (Open-Meteo)": ["temp_", "hdd", "cdd", "precip", "wind", "pac_inefficient", "elevation", "extreme_cold", "extreme_hot", "frost_days"],
    "DPE (ADEME)": ["nb_dpe", "nb_installations", "pct_pac", "pct_clim", "pct_classe"],
    "INSEE (economic)": ["confiance_menages", "climat_affaires", "chomage", "permis_construire", "prix_immobilier", "taux_pauvrete", "revenu_median", "densite_pop"],
    "Eurostat (industry)": ["ipi_", "eurostat"],
    "SITADEL (construction)": ["sitadel", "logements_autorises", "logements_commences"],
    "Feature eng. (lag/rolling)": ["lag_", "rolling_", "diff_", "trend_", "interact_", "ratio_", "seasonal_", "momentum_"],
}
OTHER_SOURCE = "Other / Identifier"

# Metric, direction that is bad, warning, critical.
ALERT_ROWS = [
    ("raw_age_days", "above", 7.0, 30.0),
    ("weather_rows", "below", 200000.0, 100000.0),
    ("certificate_rows", "below", 500000.0, 100000.0),
    ("panel_rows", "below", 2000.0, 500.0),
    ("panel_departments", "below", 90.0, 50.0),
    ("target_null_pct", "above", 5.0, 20.0),
    ("feature_null_pct", "above", 15.0, 40.0),
    ("consensus_outlier_pct", "above", 10.0, 25.0),
    ("best_model_r2", "below", 0.5, 0.2),
    ("best_model_mape", "above", 30.0, 50.0),
    ("run_minutes", "above", 60.0, 120.0),
    ("failed_collectors", "above", 0.0, 2.0),
]


def source_of(column: Column | str) -> Column:
    return E.pattern_class(column, SOURCE_PATTERNS, OTHER_SOURCE)


def nulls_by_source(df: DataFrame) -> DataFrame:
    """Columns, columns with nulls and null cells per source of origin."""
    report = null_report(df).withColumn("source", source_of("column"))
    return report.groupBy("source").agg(
        F.count(F.lit(1)).alias("cols_total"),
        F.count_if(F.col("null_count") > 0).alias("cols_with_null"),
        F.sum("null_count").alias("null_cells"),
    )


def entity_coverage(df: DataFrame, expected: DataFrame, entity: str = "dept") -> DataFrame:
    """Expected and found entities with their row count and status."""
    found = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"))
    both = expected.select(entity).distinct().withColumn("_e", F.lit(True)).join(found, entity, "full_outer")
    status = (
        F.when(F.col("n_rows").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("present")
    )
    return both.select(entity, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status"))


def coverage_summary(coverage: DataFrame) -> DataFrame:
    present = F.col("status") != "missing"
    return coverage.agg(
        F.count_if(F.col("status") == "missing").alias("n_missing"),
        F.count_if(F.col("status") == "extra").alias("n_extra"),
        F.min(F.when(present, F.col("n_rows"))).alias("rows_min"),
        F.max(F.when(present, F.col("n_rows"))).alias("rows_max"),
        E.half_even(F.avg(F.when(present, F.col("n_rows"))), 4).alias("rows_mean"),
    )


def period_gaps(df: DataFrame, keys: Sequence[str] = (), date_key: str = "date_id") -> DataFrame:
    return month_gaps(df.select(*keys, date_key).distinct(), keys, date_key)


def incomplete_entities(df: DataFrame, entity: str = "dept", date_key: str = "date_id") -> DataFrame:
    """Entities with fewer months than the table has."""
    total = df.agg(F.countDistinct(date_key)).scalar()
    per = df.groupBy(entity).agg(F.countDistinct(date_key).alias("n_months"))
    return per.withColumn("expected_months", total).filter(F.col("n_months") < F.col("expected_months"))


def freshness(df: DataFrame, date: str, as_of: str) -> DataFrame:
    """Span, coverage in months and age of a dated source at the as-of day."""
    b = df.agg(F.min(date).cast("date").alias("date_min"), F.max(date).cast("date").alias("date_max"))
    span = F.datediff("date_max", "date_min")
    age = F.datediff(F.lit(as_of).cast("date"), "date_max")
    return b.select(
        "date_min",
        "date_max",
        span.alias("span_days"),
        E.half_even(span / 30.44, 2).alias("span_months"),
        age.alias("age_days"),
        E.freshness_band(age).alias("freshness"),
    )


@dataclass(frozen=True)
class Check:
    """A named aggregate that must stay inside its bounds."""

    name: str
    value: Column
    low: float | None = None
    high: float | None = None
    severity: str = "warning"


def null_share_checks(df: DataFrame, limit: float = 5.0) -> list[Check]:
    share = lambda c: F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))
    return [Check(f"null_share:{c}", share(c), None, limit) for c in df.columns]


def range_checks(columns: Sequence[str], low: float, high: float) -> list[Check]:
    out = []
    for c in columns:
        out.append(Check(f"min:{c}", F.min(F.col(c).cast("double")), low, None))
        out.append(Check(f"max:{c}", F.max(F.col(c).cast("double")), None, high))
    return out


def rows_check(at_least: int, severity: str = "error") -> Check:
    return Check("rows", F.count(F.lit(1)).cast("double"), float(at_least), None, severity)


# The columns each source must have, and the bounds of its values.
REQUIRED = {
    "weather": ["time", "city", "dept", "temperature_2m_mean"],
    "economy": ["period"],
    "industry": ["period", "nace_r2", "ipi_value"],
    "permits": ["DEP"],
    "certificates": ["date_etablissement_dpe", "etiquette_dpe"],
}
NULL_SHARE_LIMIT = 5.0
SERIES_WANTED = 3
SERIES_RANGE = (-200.0, 500.0)
INDUSTRY_RANGE = (0.0, 300.0)
PERMIT_ROWS = 100


def source_checks(df: DataFrame, source: str) -> tuple[list[str], list[Check], str]:
    """Required columns, checks and the severity of a missing column for one of the five sources."""
    required, severity = REQUIRED[source], "error"
    count = F.count(F.lit(1)).cast("double")
    if source == "weather":
        checks = null_share_checks(df, NULL_SHARE_LIMIT)
    elif source == "economy":
        series = [c for c in df.columns if c != "period"]
        checks = [Check("series", F.max(F.lit(float(len(series)))), float(SERIES_WANTED), None, "error")]
        checks += [Check(f"nulls:{c}", F.count_if(F.col(c).isNull()), None, 0.0) for c in series]
        checks += range_checks(series, *SERIES_RANGE)
    elif source == "industry":
        checks = [Check("codes", F.countDistinct("nace_r2"), 1.0, None, "error"), *range_checks(["ipi_value"], *INDUSTRY_RANGE)]
    elif source == "permits":
        checks = [rows_check(PERMIT_ROWS, "warning")]
        checks += [Check("min:NB_LGT_TOT_CREES", F.min(F.col("NB_LGT_TOT_CREES").cast("double")), 0.0)] if "NB_LGT_TOT_CREES" in df.columns else []
    else:
        severity = "warning"
        valid = E.parse_date("date_etablissement_dpe").isNotNull()
        checks = [
            Check("invalid_date_share", F.count_if(~valid) * 100.0 / count, None, NULL_SHARE_LIMIT),
            Check("labels", F.countDistinct("etiquette_dpe"), 1.0),
        ]
    return required, checks, severity


def validate(
    df: DataFrame, source: str, required: Sequence[str], checks: Sequence[Check], missing_severity: str = "error"
) -> DataFrame:
    """One row per check from one aggregation; missing columns are known at plan time."""
    lost = E.missing(df, required)
    cells = {
        c.name: F.struct(
            c.value.cast("double").alias("value"),
            F.lit(c.low).cast("double").alias("low"),
            F.lit(c.high).cast("double").alias("high"),
            F.lit(c.severity).alias("severity"),
        )
        for c in checks
    }
    cells["missing_columns"] = F.struct(
        F.lit(float(len(lost))).alias("value"),
        F.lit(None).cast("double").alias("low"),
        F.lit(0.0).alias("high"),
        F.lit(missing_severity).alias("severity"),
    )
    rows = _rows(df, [], cells, "v")
    broken = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return rows.select(F.lit(source).alias("source"), F.col("name").alias("check"), "v.*").withColumn(
        "status", F.when(F.coalesce(broken, F.lit(False)), F.col("severity")).otherwise("pass")
    )


def gate(checks: DataFrame) -> None:
    """Stop the run where a check failed with severity error."""
    # one row per declared check, so few
    failed = checks.filter(F.col("status") == "error").select("source", "check", "value").collect()
    if failed:
        raise ValueError("; ".join(f"{r['source']}: {r['check']} = {r['value']}" for r in failed))


def alert_rules(spark) -> DataFrame:
    return spark.createDataFrame(ALERT_ROWS, "metric string, bad string, warning double, critical double")


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Level of each metric (``metric``, ``value``) against its thresholds."""
    worse = lambda mark: F.when(F.col("bad") == "above", F.col("value") > F.col(mark)).otherwise(
        F.col("value") < F.col(mark)
    )
    return metrics.join(rules, "metric").select(
        "metric",
        "value",
        F.when(worse("critical"), "CRITICAL").when(worse("warning"), "WARNING").otherwise("OK").alias("level"),
    )


def constraint_report(
    df: DataFrame,
    unique: tuple[str, Sequence[str]],
    references: Mapping[str, tuple[DataFrame, str]],
    predicates: Mapping[str, Column],
) -> DataFrame:
    """One row per constraint with its number of violations, from one pass over the rows.

    Row predicates are counted while the rows are summed up to the unique key (a name and its columns);
    references (a dimension and a column of that key) are looked up at the key's grain.
    """
    name, keys = unique
    rows = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(~F.coalesce(p, F.lit(False))).alias(f"p{i}") for i, p in enumerate(predicates.values())],
    )
    for i, (dim, key) in enumerate(references.values()):
        rows = rows.join(dim.select(F.col(key).alias(f"k{i}")).distinct(), F.col(key) == F.col(f"k{i}"), "left")
    counts = {name: F.count_if(F.col("n") > 1)}
    counts |= {c: F.sum(F.when(F.col(f"k{i}").isNull(), F.col("n")).otherwise(0)) for i, c in enumerate(references)}
    counts |= {c: F.sum(f"p{i}") for i, c in enumerate(predicates)}
    return _rows(rows, [], {c: F.coalesce(v, F.lit(0)).cast("bigint") for c, v in counts.items()}, "violations").withColumnRenamed("name", "constraint")


def _stage_measures(columns: Sequence[str]) -> list[Column]:
    cells = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return [F.count(F.lit(1)).alias("rows_after"), F.sum(cells).alias("filled"), E.fingerprint(columns).alias("fingerprint")]


def _stage_row(stage: str, before: int, after: Mapping[str, int | None], width: int) -> tuple:
    n = after["rows_after"]
    full = round(after["filled"] * 100.0 / (n * width) * 100) / 100 if n else None  # half to even
    return (stage, before, n, before - n, full, after["fingerprint"])


STAGE_RECORD = "stage string, rows_before bigint, rows_after bigint, rows_removed bigint, completeness_pct double, fingerprint bigint"


def stage_record(stage: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Lineage of one stage: rows before and after, completeness and an order-free fingerprint.

    Scans both sides; ``record_while_written`` gathers the same while a stage runs.
    """
    found = after.agg(*_stage_measures(after.columns)).first().asDict()
    row = _stage_row(stage, before.count(), found, len(after.columns))
    return after.sparkSession.createDataFrame([row], STAGE_RECORD)


def record_while_written(stage: str, before: DataFrame, make: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(the written stage, its lineage record), with every source read once.

    ``make(before)`` is the stage's plan and ``write`` runs it, stores it and reads it back; the counts are metrics
    that Spark observes on both sides of the plan during that write. Tasks run again after an executor was
    lost are observed again, so the rows written are compared with the stored files (a count from their
    footers), and in case they differ both sides are counted from scratch.
    """
    seen_before, seen_after = Observation(), Observation()
    after = make(before.observe(seen_before, F.count(F.lit(1)).alias("rows_before")))
    columns = after.columns
    stored = write(after.observe(seen_after, *_stage_measures(columns)))
    found = seen_after.get
    if found["rows_after"] != stored.count():
        return stored, stage_record(stage, before, stored)
    row = _stage_row(stage, seen_before.get["rows_before"], found, len(columns))
    return stored, stored.sparkSession.createDataFrame([row], STAGE_RECORD)


def manifest_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """New and modified entries between two manifests of (name, hash, size)."""
    old = previous.select("name", F.col("hash").alias("_h"), F.col("size").alias("_s"))
    changed = ~(F.col("hash").eqNullSafe(F.col("_h")) & F.col("size").eqNullSafe(F.col("_s")))
    return (
        current.join(old, "name", "left")
        .filter(changed)
        .select(
            "name",
            "hash",
            "size",
            F.when(F.col("_h").isNull() & F.col("_s").isNull(), "new").otherwise("modified").alias("reason"),
        )
    )
