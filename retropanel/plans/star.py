"""The star schema and its analytical SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stored types of the two fact tables.
FACT_TYPES = {
    "date_id": "int",
    "geo_id": "int",
    "nb_dpe_total": "int",
    "nb_installations_pac": "int",
    "nb_installations_clim": "int",
    "nb_dpe_classe_ab": "int",
    "temp_mean": "decimal(5,2)",
    "temp_max": "decimal(5,2)",
    "temp_min": "decimal(5,2)",
    "heating_degree_days": "decimal(8,2)",
    "cooling_degree_days": "decimal(8,2)",
    "precipitation_cumul": "decimal(8,2)",
    "nb_jours_canicule": "int",
    "nb_jours_gel": "int",
    "nb_permis_construire": "int",
    "nb_logements_autorises": "int",
    "conso_elec_mwh": "decimal(12,2)",
    "conso_gaz_mwh": "decimal(12,2)",
}
ECONOMY_TYPES = {
    "date_id": "int",
    "confiance_menages": "decimal(6,2)",
    "climat_affaires_indus": "decimal(6,2)",
    "climat_affaires_bat": "decimal(6,2)",
    "opinion_achats": "decimal(6,2)",
    "situation_fin_future": "decimal(6,2)",
    "ipi_manufacturing": "decimal(6,2)",
    "ipi_hvac_c28": "decimal(6,2)",
    "ipi_hvac_c2825": "decimal(6,2)",
}
FACT_NAMES = {
    "hdd_sum": "heating_degree_days",
    "cdd_sum": "cooling_degree_days",
    "precipitation_sum": "precipitation_cumul",
}


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Full column set with stored types; columns the source lacks are typed NULL."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).try_cast(t).alias(c)
            for c, t in types.items()
        ]
    )


def fact_installations(panel: DataFrame, geo: DataFrame) -> DataFrame:
    """Panel rows with a known department, under surrogate keys and stored types."""
    named = panel.withColumnsRenamed({k: v for k, v in FACT_NAMES.items() if k in panel.columns})
    keys = F.broadcast(geo.select("geo_id", "dept"))
    return conform(named.join(keys, "dept"), FACT_TYPES)


def fact_economy(national: DataFrame) -> DataFrame:
    return conform(national, ECONOMY_TYPES)
