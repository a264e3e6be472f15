"""Scans. File splits give the parallelism; schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.functions.expr import first_present, is_heat_pump, date_id, parse_date
from retropanel.functions.expr import has_text, in_set, to_number
from retropanel import settings as S

# The certificate fields kept from the open-data service.
CERTIFICATE_FIELDS = (
    "numero_dpe string, date_etablissement_dpe string, date_visite_diagnostiqueur string, "
    "code_postal_ban string, code_departement_ban string, code_insee_ban string, "
    "nom_commune_ban string, etiquette_dpe string, etiquette_ges string, "
    "conso_5_usages_par_m2_ep double, conso_5_usages_par_m2_ef double, "
    "emission_ges_5_usages_par_m2 double, type_batiment string, annee_construction int, "
    "periode_construction string, surface_habitable_logement double, "
    "nombre_niveau_logement int, hauteur_sous_plafond double, "
    "type_energie_principale_chauffage string, type_installation_chauffage string, "
    "type_generateur_chauffage_principal string, type_energie_principale_ecs string, "
    "type_generateur_froid string, qualite_isolation_enveloppe string, "
    "qualite_isolation_murs string, qualite_isolation_menuiseries string, "
    "qualite_isolation_plancher_haut_comble_perdu string, cout_chauffage double, "
    "cout_ecs double, cout_total_5_usages double"
)
DAILY_FIELDS = (
    "time array<string>, temperature_2m_max array<double>, temperature_2m_min array<double>, "
    "temperature_2m_mean array<double>, precipitation_sum array<double>, "
    "wind_speed_10m_max array<double>"
)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType, **options) -> DataFrame:
    """CSV of any size; empty fields are NULL and broken numbers become NULL."""
    return (
        spark.read.schema(schema)
        .options(header=True, mode="PERMISSIVE", enforceSchema=False)
        .options(**options)
        .csv(path)
    )


def sniff_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file, sep, encoding) of every file of a folder, decided on its whole content.

    Read as Latin-1, every byte is one character, so the bytes come back exactly and can be tested for
    UTF-8; the separator is the more frequent one of the file's first line.
    """
    lines = spark.read.option("encoding", "ISO-8859-1").option("header", False).schema("line string").option("sep", "\x00").option("quote", "").csv(path)
    line = F.coalesce("line", F.lit(""))
    known = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.is_valid_utf8(F.encode(line, "ISO-8859-1").cast("string")).alias("utf8"),
        (F.length(line) - F.length(F.replace(line, F.lit(";"), F.lit("")))).alias("semicolons"),
        (F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))).alias("commas"),
    )
    return known.groupBy("file").agg(
        F.when(F.sum("semicolons") > F.sum("commas"), ";").otherwise(",").alias("sep"),
        F.when(F.every("utf8"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
    )


def read_csv_any(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All-string CSV, each file with its own separator and encoding.

    One scan for every combination found (four at most), over its own files; the list of files is what the
    driver lists for any scan.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    kinds = sniff_csv(spark, path).groupBy("sep", "encoding").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("sep", "encoding").collect()
    out = None
    for k in kinds:
        one = read_csv(spark, k["files"], schema, sep=k["sep"], encoding=k["encoding"])
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], schema)


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; anything else than a number becomes NULL."""
    return df.withColumns({c: to_number(c) for c in columns})


def read_clean_or_raw(
    spark: SparkSession, clean_path: str, raw_path: str, schema: str
) -> DataFrame | None:
    """The cleaned file if there is one, else the raw one, else None."""
    for path in (clean_path, raw_path):
        if path_exists(spark, path):
            return read_csv(spark, path, schema)
    return None


def with_derived_flags(df: DataFrame) -> DataFrame:
    """Add period and flags unless a cleaning run has stored them already."""
    if "date_id" not in df.columns:
        day = parse_date("date_etablissement_dpe")
        df = df.filter(day.isNotNull()).withColumn("date_id", date_id(day))
    if "is_pac" not in df.columns:
        heating, cooling = "type_generateur_chauffage_principal", "type_generateur_froid"
        df = df.withColumns(
            {
                "is_pac": is_heat_pump(heating, cooling),
                "is_clim": has_text(cooling),
                "is_classe_ab": in_set("etiquette_dpe", S.HIGH_LABELS),
            }
        )
    return df


def read_daily_replies(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Columnar weather replies ``{"daily": {column: [..]}}`` to one row per day and place."""
    schema = f"city string, dept string, daily struct<{_struct(DAILY_FIELDS)}>"
    replies = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return replies.select(
        "city", "dept", F.inline(F.arrays_zip(*[f"daily.{n}" for n in _names(DAILY_FIELDS)]))
    )


def read_result_pages(
    spark: SparkSession, path: str, fields: str = CERTIFICATE_FIELDS, multi_line: bool = False
) -> DataFrame:
    """Pages ``{"results": [..]}`` to rows of the wanted fields; other fields are never parsed."""
    schema = f"results array<struct<{_struct(fields)}>>"
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return pages.select(F.inline("results"))


def read_observations(spark: SparkSession, path: str, series: str | None = None) -> DataFrame:
    """XML ``<Obs TIME_PERIOD= OBS_VALUE=>`` to (period, value); non-numbers are dropped."""
    schema = "_SERIES string, _TIME_PERIOD string, _OBS_VALUE string"
    obs = spark.read.format("xml").schema(schema).option("rowTag", "Obs").load(path)
    name = F.lit(series) if series else F.col("_SERIES")
    return obs.select(
        name.alias("series"),
        F.col("_TIME_PERIOD").alias("period"),
        to_number("_OBS_VALUE").alias("value"),
    ).filter(F.col("period").isNotNull() & F.col("value").isNotNull())


def safe_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A table or view, or None where it is missing or empty."""
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name)
    return None if df.isEmpty() else df


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """Ad-hoc SQL over frames registered as views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def date_range(df: DataFrame, candidates: Sequence[str] = ("time", "date", "Date")) -> DataFrame:
    """Minimum and maximum of the first date column present; the scan reads that column only."""
    name = first_present(df, candidates)
    return df.agg(F.min(name).alias("date_min"), F.max(name).alias("date_max"))


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 200) -> DataFrame:
    """The first rows in a stated order (a top-n, not a global sort)."""
    return df.orderBy(*order).limit(n)


def _names(fields: str) -> list[str]:
    return [f.strip().split(" ")[0] for f in fields.split(", ")]


def _struct(fields: str) -> str:
    return ", ".join(f.strip().replace(" ", ": ", 1) for f in fields.split(", "))
