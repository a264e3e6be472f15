"""The processing chain: clean, join, engineer, treat outliers. Two tables are stored on the way."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.operators import cleaning as C
from retropanel.operators import outliers as O
from retropanel.operators import quality as Q
from retropanel.plans.features import engineer
from retropanel.plans.panel import build_panel
from retropanel.sources.dimensions import departments_for_scope
from retropanel.sources.sinks import write_table


@dataclass(frozen=True)
class RawSources:
    """Raw frames and the columns that order their duplicates."""

    certificates: DataFrame
    certificate_order: tuple[str, ...]
    weather: DataFrame | None = None
    weather_order: tuple[str, ...] = ()
    economy: DataFrame | None = None
    economy_order: tuple[str, ...] = ()
    industry: DataFrame | None = None
    industry_order: tuple[str, ...] = ()
    permits: DataFrame | None = None
    attributes: DataFrame | None = None


def clean_panel(raw: RawSources, geo: DataFrame, cfg: S.PanelSettings) -> DataFrame:
    """Lazy plan from raw sources to the panel."""
    skip = lambda name: cfg.skip_rules.get(name, set())
    certificates = C.clean_certificates(
        raw.certificates,
        raw.certificate_order,
        departments_for_scope("FR"),
        cfg.certificate_start,
        cfg.as_of,
        skip("dpe"),
    )
    weather = economy = industry = None
    if raw.weather is not None:
        weather = C.clean_weather(raw.weather, raw.weather_order, skip("weather"))
    if raw.economy is not None:
        economy = C.clean_series(raw.economy, raw.economy_order, "insee", skip("insee"))
    if raw.industry is not None:
        industry = C.clean_series(raw.industry, raw.industry_order, "eurostat", skip("eurostat"))
    start = int(cfg.certificate_start[:4] + cfg.certificate_start[5:7])
    return build_panel(certificates, geo, weather, economy, industry, raw.permits, raw.attributes, start)


def run(raw: RawSources, geo: DataFrame, out: str, cfg: S.PanelSettings, strategy: str = "clip") -> DataFrame:
    """Run all stages; the panel and the treated feature table are written by year."""
    spark = raw.certificates.sparkSession
    write_table(clean_panel(raw, geo, cfg), f"{out}/panel", ["year"])
    panel = spark.read.parquet(f"{out}/panel")
    Q.gate(Q.validate(panel, "panel", ["date_id", "dept", *S.COUNT_COLUMNS], [Q.rows_check(10)]))
    features = engineer(panel, cfg)
    write_table(features, f"{out}/features_raw", ["year"])
    stored = spark.read.parquet(f"{out}/features_raw")
    columns = O.analysed_columns(stored)
    treated = O.treat(O.detect_and_flag(stored, ["date_id", "dept"], columns), strategy, columns)
    write_table(treated, f"{out}/features", ["year"])
    return spark.read.parquet(f"{out}/features")


def outlier_records(stored: DataFrame, columns: list[str]) -> DataFrame:
    """Fence and vote counts in one report frame."""
    fences = O.iqr_report(stored, columns).select(F.lit("iqr").alias("method"), "column", "n_outliers", "pct")
    robust = O.zscore_report(stored, columns).select(F.lit("zscore").alias("method"), "column", "n_outliers", "pct")
    return fences.unionByName(robust)
