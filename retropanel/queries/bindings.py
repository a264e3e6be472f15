"""The reference roles played by the given tables.

Certificates are orders (department from the customer's nation, label from the price, texts from the
priority and segment); daily weather and permits are line items at the supplier's nation; national
series are monthly averages; area attributes come from customers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import cleaning as C
from retropanel.plans import panel as P
from retropanel.plans.features import engineer
from retropanel.plans.process import RawSources, clean_panel
from retropanel.queries import sqlviews as V
from retropanel.session import materialize
from retropanel.sources.dimensions import departments_for_scope, geo_dimension
from retropanel.sources.readers import path_exists

CFG = S.PanelSettings(
    certificate_start=V.START, as_of=V.AS_OF, train_end=V.TRAIN_END, val_end=V.VAL_END
)
CERT_ORDER = ("date_etablissement_dpe", "numero_dpe")
WX_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


_HANDLES: dict[tuple[SparkSession, str, str], DataFrame] = {}


def state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of a table's files: what a kept handle or stage is good for."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return ";".join(f"{f.getPath().getName()},{f.getLen()},{f.getModificationTime()}" for f in fs.listStatus(target))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Lazy handle of a given table; the footer is read again once its files have changed."""
    path = f"{sf}/{name}.parquet"
    key = (spark, path, state(spark, path))
    if key not in _HANDLES:
        _HANDLES[key] = spark.read.parquet(path)
    return _HANDLES[key]


def cert_raw(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    price = F.col("o_totalprice")
    label = F
    for letter, top in zip("ABCDEFG", range(50000, 400000, 50000)):
        label = label.when(price < top, letter)
    heating = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "PAC air/eau")
        .when(F.col("o_orderpriority") == "2-HIGH", "Chaudiere gaz  ")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Pompe a chaleur geothermique")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Radiateur electrique")
        .otherwise("Poele bois")
    )
    cooling = (
        F.when(F.col("c_mktsegment") == "BUILDING", "PAC reversible")
        .when(F.col("c_mktsegment") == "MACHINERY", "Climatisation")
        .when(F.col("c_mktsegment") != "HOUSEHOLD", "")
    )
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("numero_dpe"),
        F.col("o_orderdate").cast("date").cast("string").alias("date_etablissement_dpe"),
        (F.col("c_nationkey") + 1).cast("string").alias("code_departement_ban"),
        label.otherwise("N/A").alias("etiquette_dpe"),
        heating.alias("type_generateur_chauffage_principal"),
        cooling.alias("type_generateur_froid"),
        F.floor(price / 400).cast("double").alias("surface_habitable_logement"),
        F.floor(price / 300).cast("double").alias("conso_5_usages_par_m2_ep"),
        F.floor(price / 9).cast("double").alias("cout_total_5_usages"),
    )


def cert(spark: SparkSession, sf: str, skip: frozenset[str] = frozenset()) -> DataFrame:
    """Cleaned certificates, duplicates removed as in every run of the chain."""
    return C.clean_certificates(
        cert_raw(spark, sf), CERT_ORDER, departments_for_scope("FR"), V.START, V.AS_OF, skip
    )


def supplied_lines(spark: SparkSession, sf: str) -> DataFrame:
    l, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    dept = (F.col("s_nationkey") + 1).cast("string")
    return l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("_dept", dept)


def wx_raw(spark: SparkSession, sf: str) -> DataFrame:
    q = F.when(F.col("l_quantity") != 50, F.col("l_quantity") * 2)
    return supplied_lines(spark, sf).select(
        F.col("l_shipdate").cast("date").alias("time"),
        F.col("_dept").alias("dept"),
        (q - 40).alias("temperature_2m_mean"),
        (q - 35).alias("temperature_2m_max"),
        (q - 45).alias("temperature_2m_min"),
        (F.round(F.col("l_tax") * 100) * 45).alias("precipitation_sum"),
        (F.round(F.col("l_discount") * 100) * 22).alias("wind_speed_10m_max"),
        *WX_ORDER,
    )


def wx(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_weather(wx_raw(spark, sf), WX_ORDER).drop(*WX_ORDER, "year", "month")


def _quarter(day: str) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def eco_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series, a second batch of them from open orders, and quarterly ones: one scan of the orders."""
    v = F.floor("o_totalprice").cast("double")
    m = F.month("o_orderdate")
    on = lambda cond: F.avg(F.when(cond, v))
    prio = F.col("o_orderpriority")
    month = F.date_format("o_orderdate", "yyyy-MM")
    key = lambda period, batch: F.struct(period.alias("period"), F.lit(batch).alias("batch_no"))
    keys = F.array(key(month, 1), F.when(F.col("o_orderstatus") == "O", key(month, 2)), key(_quarter("o_orderdate"), 1))
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderdate", "o_orderpriority", F.inline(F.array_compact(keys)))
    return orders.groupBy("period", "batch_no").agg(
        (F.avg(v) / 2500).alias("confiance_menages"),
        (on(prio == "1-URGENT") / 2500).alias("climat_affaires_industrie"),
        (on(~m.isin(5, 6, 7, 8, 9)) / 2500).alias("climat_affaires_batiment"),
        (on(prio == "2-HIGH") / 2500 - 100).alias("opinion_achats_importants"),
        (on((prio == "5-LOW") & ~m.isin(3, 11)) / 2500 - 100).alias("situation_financiere_future"),
        (on(prio == "3-MEDIUM") / 2500).alias("ipi_industrie_manuf"),
    )


def ind_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly and quarterly values of each code from one scan of the line items."""
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", "C25").when(flag == "N", "C28").otherwise("C2825")
    shown = ~((flag == "N") & F.month("l_shipdate").isin(4, 5))
    value = F.avg(F.when(shown, F.floor("l_extendedprice").cast("double"))) / 500
    periods = F.array(F.date_format("l_shipdate", "yyyy-MM"), _quarter("l_shipdate"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice", F.explode(periods).alias("period"))
    return lines.groupBy("period", code.alias("nace_r2")).agg(F.lit(1).alias("batch_no"), value.alias("ipi_value"))


def permit_raw(spark: SparkSession, sf: str) -> DataFrame:
    fmt = F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return supplied_lines(spark, sf).select(
        fmt.alias("DATE_PRISE_EN_COMPTE"),
        F.col("_dept").alias("DEP"),
        F.col("l_quantity").alias("NB_LGT_TOT_CREES"),
        F.col("l_linenumber").cast("double").alias("NB_LGT_IND_CREES"),
        F.floor(F.col("l_extendedprice") / 10000).cast("double").alias("NB_LGT_COLL_CREES"),
        F.floor("l_extendedprice").cast("double").alias("SURF_TOT_M2"),
    )


def attr_raw(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    bal = F.floor("c_acctbal").cast("double")
    seg = F.col("c_mktsegment")
    n = F.count(F.lit(1))
    return c.groupBy((F.col("c_nationkey") + 1).cast("string").alias("dept")).agg(
        E.half_even(F.avg(bal), 2).alias("revenu_median"),
        (n * 100).alias("nb_logements_total"),
        E.half_even(F.count_if(seg == "HOUSEHOLD") * 100.0 / n, 1).alias("pct_maisons"),
        F.floor(F.avg(bal) / 5).cast("double").alias("altitude_mean"),
        E.half_even(F.count_if(seg == "BUILDING") * 300.0 / n, 1).alias("pct_zone_montagne"),
        F.count_if(F.col("c_acctbal") > 0).cast("double").alias("densite_pop"),
    )


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return P.certificate_target(cert(spark, sf))


def sources(spark: SparkSession, sf: str) -> RawSources:
    return RawSources(
        certificates=cert_raw(spark, sf),
        certificate_order=CERT_ORDER,
        weather=wx_raw(spark, sf),
        weather_order=WX_ORDER,
        economy=eco_raw(spark, sf),
        economy_order=("batch_no",),
        industry=ind_raw(spark, sf),
        industry_order=("batch_no",),
        permits=permit_raw(spark, sf),
        attributes=attr_raw(spark, sf),
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return clean_panel(sources(spark, sf), geo_dimension(spark), CFG)


_STORED: dict[tuple[SparkSession, str, str], tuple[str, DataFrame]] = {}
PANEL_TABLES = ("orders", "customer", "lineitem", "supplier")


def _stored(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage table of this session, as a run of the chain writes it: built again once an input changes."""
    key = (spark, name, ";".join(f"{sf}/{t}:{state(spark, f'{sf}/{t}.parquet')}" for t in PANEL_TABLES))
    if key not in _STORED or not path_exists(spark, _STORED[key][0]):
        df = materialize(build())
        _STORED[key] = (df.inputFiles()[0].rsplit("/", 1)[0], df)
    return _STORED[key][1]


def stored_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The panel written once, for plans that read it several times."""
    return _stored(spark, sf, "panel", lambda: panel(spark, sf))


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the stored panel with target windows that end the month before."""
    return _stored(
        spark, sf, "features", lambda: engineer(stored_panel(spark, sf), CFG, shift_target_windows=True)
    )
