"""Cleaning as named rules per source, composed with ``transform``.

A rule has a row-level condition for the preview and a transformation; the preview counts all rules of
a source in one aggregation and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators.dedup import keep_last
from retropanel.operators.gaps import interpolate


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    apply: Callable[[DataFrame], DataFrame]
    affected: Column | None = None  # rows or values it touches, summed over the source


@dataclass(frozen=True)
class Source:
    """What cleaning must know about one source."""

    name: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    rules: tuple[Rule, ...]


def _dedup(keys, order, what) -> Rule:
    return Rule(
        "remove_duplicates", f"Keep the last row per {what}", lambda df: keep_last(df, keys, order)
    )


def clipped_values(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Number of out-of-bounds values in a row."""
    total = F.lit(0)
    for c in E.present(df, bounds):
        total = total + E.outside(c, *bounds[c]).cast("int")
    return total


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: E.clip(c, *map(float, bounds[c])) for c in E.present(df, bounds)})


def weather_source(df: DataFrame, order: Sequence[str]) -> Source:
    day = E.first_present(df, ("time", "date"))
    place = E.first_present(df, ("city", "dept"))
    keys = (day, place) if place else (day,)
    temps = [c for c in df.columns if "temperature" in c.lower()]
    none = F.lit(True)
    for c in temps:
        none = none & F.col(c).isNull()
    return Source(
        "weather",
        keys,
        tuple(order),
        (
            _dedup(keys, order, "day and place"),
            Rule(
                "remove_nan_temps",
                "Drop rows without any temperature",
                lambda d: d.na.drop("all", subset=temps),
                none.cast("int") if temps else F.lit(0),
            ),
            Rule(
                "clip_outliers",
                "Clip to physical bounds",
                lambda d: clip_columns(d, S.WEATHER_BOUNDS),
                clipped_values(df, S.WEATHER_BOUNDS),
            ),
            Rule("recompute_hdd_cdd", "Degree days from the mean temperature", degree_days),
        ),
    )


def degree_days(df: DataFrame) -> DataFrame:
    if "temperature_2m_mean" not in df.columns:
        return df
    return df.withColumns(
        {
            "hdd": E.half_even(E.heating_degrees("temperature_2m_mean"), 2),
            "cdd": E.half_even(E.cooling_degrees("temperature_2m_mean"), 2),
        }
    )


def series_source(df: DataFrame, order: Sequence[str], name: str = "insee") -> Source:
    """National monthly series: wide, or long with a ``nace_r2`` code."""
    coded = "nace_r2" in df.columns
    keys = ("period", "nace_r2") if coded else ("period",)
    values = [c for c in E.numeric_columns(df, ("date_id",)) if c not in order]

    def fill(d: DataFrame) -> DataFrame:
        if coded:
            return interpolate(d, "ipi_value", ["nace_r2"], "date_id")
        return interpolate(d.withColumn("_series", F.lit(name)), values, ["_series"], "date_id").drop("_series")

    return Source(
        name,
        keys,
        tuple(order),
        (
            Rule(
                "filter_non_monthly",
                "Keep monthly periods",
                lambda d: d.filter(E.is_monthly("period")),
                (~E.is_monthly("period")).cast("int"),
            ),
            _dedup(keys, order, " and ".join(keys)),
            Rule("interpolate_gaps", "Fill gaps of up to three months", fill),
        ),
    )


def certificate_source(
    df: DataFrame,
    order: Sequence[str],
    departments: Sequence[str],
    start: str,
    as_of: str,
) -> Source:
    day = E.parse_date("date_etablissement_dpe")
    valid_day = F.coalesce(day.between(F.lit(start).cast("date"), F.lit(as_of).cast("date")), F.lit(False))
    valid_label = F.coalesce(F.trim("etiquette_dpe").isin(*S.VALID_LABELS), F.lit(False))
    valid_dept = E.known_code("code_departement_ban", departments)
    return Source(
        "dpe",
        ("numero_dpe",),
        tuple(order),
        (
            _dedup(("numero_dpe",), order, "certificate"),
            Rule(
                "filter_invalid_dates",
                "Keep dates between the start of the label and the as-of day",
                lambda d: d.filter(valid_day),
                (~valid_day).cast("int"),
            ),
            Rule(
                "filter_invalid_labels",
                "Keep labels A to G",
                lambda d: d.filter(valid_label),
                (~valid_label).cast("int"),
            ),
            Rule(
                "clip_outliers",
                "Clip surface, consumption and cost",
                lambda d: clip_columns(d, S.CERTIFICATE_BOUNDS),
                clipped_values(df, S.CERTIFICATE_BOUNDS),
            ),
            Rule(
                "filter_invalid_depts",
                "Keep known departments",
                lambda d: d.filter(valid_dept),
                (~valid_dept).cast("int"),
            ),
        ),
    )


def apply_rules(df: DataFrame, source: Source, skip: set[str] = frozenset()) -> DataFrame:
    for rule in source.rules:
        if rule.name not in skip:
            df = df.transform(rule.apply)
    return df


def preview(df: DataFrame, source: Source) -> DataFrame:
    """Rows (or values) each rule would touch, with the share of all rows: one shuffle per source."""
    counted = {r.name: r.affected for r in source.rules if r.affected is not None}
    per_key = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(source.keys)]).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(name) for name, c in counted.items()],
    )
    totals = per_key.agg(
        F.sum("_n").alias("_total"),
        F.sum(F.col("_n") - 1).alias("remove_duplicates"),
        *[F.sum(name).alias(name) for name in counted],
    )
    rules = ["remove_duplicates", *counted]
    return (
        totals.unpivot(["_total"], rules, "rule", "rows_affected")
        .select(
            F.lit(source.name).alias("source"),
            "rule",
            F.coalesce(F.col("rows_affected").cast("bigint"), F.lit(0)).alias("rows_affected"),
            E.percentage(F.coalesce("rows_affected", F.lit(0)), F.coalesce("_total", F.lit(0)), 1).alias("pct"),
        )
    )


def clean_weather(df: DataFrame, order: Sequence[str], skip: set[str] = frozenset()) -> DataFrame:
    day = E.first_present(df, ("time", "date"))
    dated = df.withColumn(day, E.parse_date(day)).filter(F.col(day).isNotNull())
    out = apply_rules(dated, weather_source(dated, order), skip)
    out = out.withColumns(
        {"year": F.year(day), "month": F.month(day), "date_id": E.date_id(day)}
    )
    if "dept" in out.columns:
        out = out.withColumn("dept", E.pad_code("dept"))
    return E.round_doubles(out, 2)


def clean_series(
    df: DataFrame, order: Sequence[str], name: str = "insee", skip: set[str] = frozenset()
) -> DataFrame:
    source = series_source(df, order, name)
    keyed = df.withColumn("date_id", E.period_to_id("period"))
    return E.round_doubles(apply_rules(keyed, source, skip), 2)


def clean_certificates(
    df: DataFrame,
    order: Sequence[str],
    departments: Sequence[str],
    start: str,
    as_of: str,
    skip: set[str] = frozenset(),
) -> DataFrame:
    """Deduplicate over the whole table first, then filter, clip and derive."""
    source = certificate_source(df, order, departments, start, as_of)
    out = E.trim_strings(apply_rules(df, source, skip))
    day = E.parse_date("date_etablissement_dpe")
    heating, cooling = "type_generateur_chauffage_principal", "type_generateur_froid"
    out = out.filter(day.isNotNull()).withColumns(
        {
            "date_etablissement_dpe": day,
            "code_departement_ban": E.pad_code("code_departement_ban"),
            "year": F.year(day),
            "month": F.month(day),
            "date_id": E.date_id(day),
            "is_pac": E.is_heat_pump(heating, cooling),
            "is_clim": E.has_text(cooling),
            "is_classe_ab": E.in_set("etiquette_dpe", S.HIGH_LABELS),
        }
    )
    return E.round_doubles(out.drop("_score"), 2)


def certificate_stats(
    df: DataFrame,
    order: Sequence[str],
    departments: Sequence[str],
    start: str,
    as_of: str,
) -> DataFrame:
    """One row of counts in rule order: what each step removes or clips after the steps before it."""
    rules = {r.name: r for r in certificate_source(df, order, departments, start, as_of).rules}
    bad_day, bad_label, bad_dept = (
        rules[n].affected == 1
        for n in ("filter_invalid_dates", "filter_invalid_labels", "filter_invalid_depts")
    )
    per_key = keep_last(df.withColumn("_n", F.lit(1)), ["numero_dpe"], order)
    counts = df.groupBy("numero_dpe").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.sum("_n").alias("rows_in"), F.sum(F.col("_n") - 1).alias("duplicates_removed")
    )
    kept = per_key.agg(
        F.count_if(bad_day).alias("date_invalid_removed"),
        F.count_if(~bad_day & bad_label).alias("label_invalid_removed"),
        F.coalesce(
            F.sum(F.when(~bad_day & ~bad_label, rules["clip_outliers"].affected)), F.lit(0)
        ).alias("values_clipped"),
        F.count_if(~bad_day & ~bad_label & bad_dept).alias("dept_invalid_removed"),
        F.count_if(~bad_day & ~bad_label & ~bad_dept).alias("rows_out"),
    )
    both = counts.select(F.struct("*").alias("c")).scalar()
    return kept.withColumn("_c", both).select(
        F.col("_c.rows_in"), F.col("_c.duplicates_removed"), *kept.columns
    )
