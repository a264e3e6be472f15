"""The month x department panel from the five sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import aggregates as A
from retropanel.operators import joins as J
from retropanel.operators.reshape import pivot_first
from retropanel.sources.readers import with_derived_flags


def certificate_target(certificates: DataFrame) -> DataFrame:
    """Counts and percentages per month and department, from cleaned or raw certificates."""
    flagged = with_derived_flags(certificates).withColumn("dept", E.pad_code("code_departement_ban"))
    return A.ratio_columns(A.event_counts(flagged))


def weather_features(weather: DataFrame) -> DataFrame:
    day = E.first_present(weather, ("time", "date"))
    keyed = weather if "date_id" in weather.columns else weather.withColumn("date_id", E.date_id(day))
    return A.monthly_weather(keyed.withColumn("dept", E.pad_code("dept")))


def wide_series(series: DataFrame) -> DataFrame:
    """National indicators renamed to panel names, one row per month."""
    monthly = series.filter(E.is_monthly("period"))
    if "date_id" not in monthly.columns:
        monthly = monthly.withColumn("date_id", E.period_to_id("period"))
    have = E.present(monthly, S.ECONOMY_NAMES)
    return monthly.select("date_id", *[F.col(c).alias(S.ECONOMY_NAMES[c]) for c in have])


def industry_series(series: DataFrame, order: Sequence[str] = ("ipi_value",)) -> DataFrame:
    monthly = series.filter(E.is_monthly("period"))
    if "date_id" not in monthly.columns:
        monthly = monthly.withColumn("date_id", E.period_to_id("period"))
    return pivot_first(monthly, ["date_id"], "nace_r2", "ipi_value", S.INDUSTRY_NAMES, order)


def economic_features(wide: DataFrame | None, industry: DataFrame | None) -> DataFrame | None:
    if wide is None or industry is None:
        return E.round_doubles(wide or industry) if (wide or industry) else None
    return E.round_doubles(J.outer_on_period(wide, industry))


def permit_features(permits: DataFrame) -> DataFrame:
    """Permits summed per month and department; both date formats are accepted."""
    named = E.rename_absent(permits, S.PERMIT_ALIASES)
    have = E.present(named, S.PERMIT_NAMES)
    keyed = named.select(
        E.period_to_id("DATE_PRISE_EN_COMPTE").alias("date_id"),
        E.pad_code("DEP").alias("dept"),
        *[F.col(c).alias(S.PERMIT_NAMES[c]) for c in have],
    )
    return A.sum_measures(keyed, ["date_id", "dept"], [S.PERMIT_NAMES[c] for c in have])


def area_attributes(attributes: DataFrame, geo: DataFrame) -> DataFrame:
    """Static attributes per department; the reference elevation stands in for a missing altitude."""
    keep = E.present(
        attributes,
        (
            "revenu_median",
            "prix_m2_median",
            "nb_logements_total",
            "pct_maisons",
            "altitude",
            "altitude_mean",
            "pct_zone_montagne",
            "densite_pop",
        ),
    )
    out = attributes.withColumn("dept", E.pad_code("dept")).select("dept", *keep)
    if "altitude" not in keep:
        out = J.lookup_or(out, geo.withColumnRenamed("elevation", "altitude"), "dept", "altitude", F.lit(0.0))
    return out


def build_panel(
    certificates: DataFrame,
    geo: DataFrame,
    weather: DataFrame | None = None,
    economy: DataFrame | None = None,
    industry: DataFrame | None = None,
    permits: DataFrame | None = None,
    attributes: DataFrame | None = None,
    start: int | None = None,
) -> DataFrame:
    """Left-join every source, at its own grain, onto the certificate counts.

    ``start`` cuts the panel before the joins: the key exists on the certificate side only once.
    """
    panel = certificate_target(certificates)
    if start is not None:
        panel = panel.filter(F.col("date_id") >= start)
    if weather is not None:
        panel = J.left_with_suffix(panel, weather_features(weather), ["date_id", "dept"], "_meteo")
    national = economic_features(
        wide_series(economy) if economy is not None else None,
        industry_series(industry) if industry is not None else None,
    )
    if national is not None:
        panel = J.left_with_suffix(panel, national, ["date_id"], "_eco")
    if permits is not None:
        panel = J.left_with_suffix(panel, permit_features(permits), ["date_id", "dept"], "_sitadel")
    if attributes is not None:
        panel = J.left_with_suffix(panel, area_attributes(attributes, geo), ["dept"], "_ref")
    panel = panel.withColumns(E.calendar_columns())
    return A.rate_columns(J.with_geography(panel, geo))
