"""Seeded synthetic source rows, computed row by row from keys on the executors."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retropanel.functions.expr import half_even


def noise(day: Column, place: Column, salt: int) -> Column:
    """Deterministic uniform number in [0, 1) from a day and a place."""
    n = F.datediff(day, F.lit("1990-01-01").cast("date")).cast("bigint")
    mixed = (n * 7919 + place * 104729 + n * place * 31 + F.lit(salt).cast("bigint") * 1299709) % 10007
    return mixed / F.lit(10007.0)


def synthetic_weather(places: DataFrame, first: Column, last: Column) -> DataFrame:
    """Daily weather for each place (``dept``, ``place`` number, ``latitude``) between two dates.

    A yearly cycle around a base that falls with latitude, plus noise.
    """
    days = places.select(
        "dept", "place", "latitude", F.explode(F.sequence(first, last)).alias("time")
    )
    base = 15.0 - (F.col("latitude") - 43.0) * 1.2
    wave = 12.0 * F.sin(F.lit(2 * math.pi) * (F.dayofyear("time") - 80) / 365.0)
    day, place = F.col("time"), F.col("place")
    mean = base + wave + (noise(day, place, 1) - 0.5) * 6.0
    rows = days.withColumn("_t", mean)
    return rows.select(
        "time",
        "dept",
        half_even(F.col("_t") + 3.0 + noise(day, place, 2) * 5.0, 1).alias("temperature_2m_max"),
        half_even(F.col("_t") - 3.0 - noise(day, place, 3) * 5.0, 1).alias("temperature_2m_min"),
        half_even("_t", 1).alias("temperature_2m_mean"),
        half_even(F.greatest(F.lit(0.0), noise(day, place, 4) * 9.0 - 4.0), 1).alias(
            "precipitation_sum"
        ),
        half_even(noise(day, place, 5) * 40.0, 1).alias("wind_speed_10m_max"),
    )


def synthetic_certificates(places: DataFrame, first: Column, last: Column, per_day: int) -> DataFrame:
    """Certificates per place and day with label, heating and cooling texts drawn by hash."""
    texts = F.array(
        *[
            F.lit(t)
            for t in (
                "PAC air/eau",
                "PAC air/air",
                "Chaudiere gaz",
                "Chaudiere fioul",
                "Radiateur electrique",
                "Poele bois",
            )
        ]
    )
    cooling = F.array(*[F.lit(t) for t in ("", "", "Climatisation", "PAC reversible")])
    rows = places.select(
        "dept", "place", F.explode(F.sequence(first, last)).alias("day")
    ).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(per_day))))
    draw = lambda salt: noise(F.col("day"), F.col("place") * 64 + F.col("k"), salt)
    return rows.select(
        F.format_string("DPE-%s-%s-%d", "dept", F.date_format("day", "yyyyMMdd"), "k").alias(
            "numero_dpe"
        ),
        F.col("day").alias("date_etablissement_dpe"),
        F.col("dept").alias("code_departement_ban"),
        F.element_at(
            F.array(*[F.lit(x) for x in "ABCDEFG"]), (F.floor(draw(11) * 7) + 1).cast("int")
        ).alias("etiquette_dpe"),
        F.element_at(texts, (F.floor(draw(12) * 6) + 1).cast("int")).alias(
            "type_generateur_chauffage_principal"
        ),
        F.element_at(cooling, (F.floor(draw(13) * 4) + 1).cast("int")).alias(
            "type_generateur_froid"
        ),
        half_even(15.0 + draw(14) * 150.0, 1).alias("surface_habitable_logement"),
    )


def _month_noise(month: Column, place: Column | int, salt: int, spread: float) -> Column:
    """A number in [-spread, spread) for a month."""
    place = F.lit(place).cast("bigint") if isinstance(place, int) else place
    return (noise(month, place, salt) - 0.5) * (2.0 * spread)


# Level and spread of each national series, and whether it stays between 70 and 130.
ECONOMY_SERIES = {
    "confiance_menages": (100.0, 12.0, True),
    "climat_affaires_industrie": (100.0, 16.0, True),
    "climat_affaires_batiment": (95.0, 12.0, True),
    "opinion_achats_importants": (-15.0, 16.0, False),
    "situation_financiere_future": (-5.0, 10.0, False),
    "ipi_industrie_manuf": (100.0, 10.0, True),
}
# Level of each industry code.
INDUSTRY_LEVELS = {"C25": 105.0, "C28": 98.0, "C2825": 92.0}


def synthetic_economy(months: DataFrame) -> DataFrame:
    """One row per month (``month_start``) with the national series."""
    m = F.col("month_start")
    series = []
    for salt, (name, (level, spread, bounded)) in enumerate(ECONOMY_SERIES.items(), 21):
        value = F.lit(level) + _month_noise(m, 0, salt, spread)
        if bounded:
            value = F.greatest(F.lit(70.0), F.least(F.lit(130.0), value))
        series.append(half_even(value, 1).alias(name))
    return months.select(F.date_format(m, "yyyy-MM").alias("period"), *series)


def synthetic_industry(months: DataFrame) -> DataFrame:
    """One row per month and industry code."""
    m = F.col("month_start")
    codes = F.array(*[F.struct(F.lit(c).alias("nace_r2"), F.lit(v).alias("level"), F.lit(i).cast("bigint").alias("k")) for i, (c, v) in enumerate(INDUSTRY_LEVELS.items(), 1)])
    rows = months.select("month_start", F.inline(codes))
    return rows.select(
        F.date_format(m, "yyyy-MM").alias("period"),
        "nace_r2",
        F.lit("FR").alias("geo"),
        half_even(F.col("level") + _month_noise(m, F.col("k"), 31, 16.0), 1).alias("ipi_value"),
        F.lit("I21").alias("unit"),
        F.lit("SCA").alias("s_adj"),
    )


def synthetic_permits(places: DataFrame, months: DataFrame) -> DataFrame:
    """Permits of each place (``dept``, ``place``) and month: a rate of its own times a yearly wave."""
    m, place = F.col("month_start"), F.col("place")
    first = F.lit("1990-01-01").cast("date")
    span = months.agg(F.sort_array(F.collect_set("month_start")).alias("months")).scalar()  # the calendar
    rows = places.select("dept", "place", F.explode(span).alias("month_start"))
    base = 50.0 + noise(first, place, 41) * 450.0
    wave = 1.0 + 0.3 * F.sin(F.lit(2 * math.pi) * (F.month(m) - 3) / 12.0)
    n = F.greatest(F.lit(1), F.floor(base * wave * (0.9 + noise(m, place, 42) * 0.2)).cast("bigint"))
    return rows.withColumn("_n", n).select(
        F.col("dept").alias("DEP"),
        F.date_format(m, "yyyy-MM").alias("DATE_PRISE_EN_COMPTE"),
        F.col("_n").alias("NB_LGT_TOT_CREES"),
        F.floor(F.col("_n") * 0.4).alias("NB_LGT_IND_CREES"),
        F.floor(F.col("_n") * 0.6).alias("NB_LGT_COLL_CREES"),
        F.floor(F.col("_n") * (60.0 + noise(m, place, 43) * 40.0)).alias("SURF_TOT_M2"),
    )
