"""Scans and sinks. Each writes data derived from the tables to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import aggregates as A
from retropanel.operators.dedup import exact_distinct
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import AS_OF, START, WX_ORDER, date_id, he, pac, pad
from retropanel.session import scratch_path
from retropanel.sources import dimensions as D
from retropanel.sources import generator as G
from retropanel.sources import readers as R
from retropanel.sources import sinks as K

CERT_CSV = (
    "numero_dpe bigint, date_etablissement_dpe string, code_departement_ban string, "
    "etiquette_dpe string, type_generateur_chauffage_principal string, type_generateur_froid string, "
    "surface_habitable_logement double, conso_5_usages_par_m2_ep double, cout_total_5_usages double"
)


def cert_csv(spark, sf, **options):
    path = scratch_path(spark, "cert_csv")
    trimmed = E.trim_strings(B.cert_raw(spark, sf))
    trimmed.write.options(header=True, **options).csv(path)
    return path


@query(
    "s1_csv_scan",
    """SELECT numero_dpe, date_etablissement_dpe, code_departement_ban, etiquette_dpe,
  trim(type_generateur_chauffage_principal) AS type_generateur_chauffage_principal,
  CASE WHEN trim(type_generateur_froid) <> '' THEN trim(type_generateur_froid) END AS type_generateur_froid,
  surface_habitable_logement, conso_5_usages_par_m2_ep, cout_total_5_usages FROM v_cert_raw""",
)
def s1(spark, sf):
    return R.read_csv(spark, cert_csv(spark, sf), CERT_CSV, nullValue="", emptyValue="")


@query(
    "s2_large_csv_scan",
    f"""SELECT {date_id('CAST(date_etablissement_dpe AS DATE)')} AS date_id, count(*) AS n,
  sum(cout_total_5_usages) AS cost FROM v_cert_raw GROUP BY 1""",
)
def s2(spark, sf):
    df = R.read_csv(spark, cert_csv(spark, sf), CERT_CSV)
    return df.groupBy(E.date_id(E.parse_date("date_etablissement_dpe")).alias("date_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cout_total_5_usages").alias("cost")
    )


@query(
    "s3_csv_separator_encoding",
    "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name || ' é' AS libelle, c_mktsegment AS segment FROM customer",
)
def s3(spark, sf):
    path = scratch_path(spark, "semicolon")
    B.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("code"),
        F.concat("c_name", F.lit(" é")).alias("libelle"),
        F.col("c_mktsegment").alias("segment"),
    ).write.options(header=True, sep=";", encoding="UTF-8").csv(path)
    return R.read_csv_any(spark, path, ["code", "libelle", "segment"])


def encoded_folder(spark, sf, encodings):
    """Customers as one folder of semicolon files, a part of the rows in each encoding, under ASCII headers."""
    path, c = scratch_path(spark, "encodings"), B.table(spark, sf, "customer")
    rows = c.select(
        F.col("c_custkey").cast("string").alias("code"),
        F.concat("c_name", F.lit(" é")).alias("libelle"),
        F.col("c_mktsegment").alias("segment"),
    )
    for i, encoding in enumerate(encodings):
        part = rows.filter(F.col("code").cast("bigint") % len(encodings) == i)
        part.write.mode("append").options(header=True, sep=";", encoding=encoding).csv(path)
    return path


ENCODED = "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name || ' é' AS libelle, c_mktsegment AS segment FROM customer"


@query("s3_csv_latin1_body", ENCODED)
def s3_latin1(spark, sf):
    return R.read_csv_any(spark, encoded_folder(spark, sf, ["ISO-8859-1"]), ["code", "libelle", "segment"])


@query("s3_csv_mixed_folder", ENCODED)
def s3_mixed(spark, sf):
    return R.read_csv_any(spark, encoded_folder(spark, sf, ["UTF-8", "ISO-8859-1"]), ["code", "libelle", "segment"])


@query(
    "s4_all_string_coercion",
    """SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(NULL AS DOUBLE) AS l_returnflag,
  CASE WHEN l_linestatus = 'F' THEN l_quantity END AS l_quantity FROM lineitem""",
)
def s4(spark, sf):
    path = scratch_path(spark, "strings")
    B.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string"))
        .otherwise("ND")
        .alias("l_quantity"),
    ).write.option("header", True).csv(path)
    names = ["l_orderkey", "l_returnflag", "l_quantity"]
    return R.coerce_numbers(R.read_csv_any(spark, path, names), names)


@query(
    "s5_clean_else_raw",
    "SELECT DATE_PRISE_EN_COMPTE, DEP, SURF_TOT_M2 FROM v_permit_raw",
)
def s5(spark, sf):
    raw = scratch_path(spark, "permits_raw")
    B.permit_raw(spark, sf).select("DATE_PRISE_EN_COMPTE", "DEP", "SURF_TOT_M2").write.option(
        "header", True
    ).csv(raw)
    schema = "DATE_PRISE_EN_COMPTE string, DEP string, SURF_TOT_M2 double"
    return R.read_clean_or_raw(spark, scratch_path(spark, "permits_clean"), raw, schema)


@query(
    "s6_precomputed_columns",
    f"""SELECT numero_dpe, {date_id('CAST(date_etablissement_dpe AS DATE)')} AS date_id,
  {pac('type_generateur_chauffage_principal', 'type_generateur_froid')} AS is_pac,
  CAST(length(coalesce(type_generateur_froid, '')) > 0 AS INTEGER) AS is_clim,
  CAST(etiquette_dpe IN ('A', 'B') AS INTEGER) AS is_classe_ab FROM v_cert_raw""",
)
def s6(spark, sf):
    once = R.with_derived_flags(B.cert_raw(spark, sf))
    return R.with_derived_flags(once).select("numero_dpe", "date_id", "is_pac", "is_clim", "is_classe_ab")


@query(
    "s7_columnar_json",
    """SELECT CAST(time AS VARCHAR) AS time, dept, temperature_2m_max, temperature_2m_min, temperature_2m_mean,
  precipitation_sum, wind_speed_10m_max FROM v_wx_last""",
)
def s7(spark, sf):
    from retropanel.operators.dedup import keep_last

    path = scratch_path(spark, "weather_json")
    names = list(S.WEATHER_BOUNDS)
    daily = keep_last(B.wx_raw(spark, sf), ["time", "dept"], B.WX_ORDER)
    # one reply holds one place and year of deduplicated days: at most 366 entries
    packed = daily.groupBy("dept", F.year("time").alias("y")).agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("time").cast("string").alias("time"), *names))
        ).alias("d")
    )
    arrays = [F.col("d")[n].alias(n) for n in ("time", *names)]
    packed.select(
        F.concat(F.lit("place "), "dept").alias("city"), "dept", F.struct(*arrays).alias("daily")
    ).write.option("ignoreNullFields", False).json(path)
    return R.read_daily_replies(spark, path).drop("city")


@query(
    "s8_paged_json_results",
    "SELECT c_custkey AS custkey, c_mktsegment AS segment, c_acctbal AS balance FROM customer",
)
def s8(spark, sf):
    path = scratch_path(spark, "pages_json")
    rows = F.struct(
        F.col("c_custkey").alias("custkey"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_name").alias("ignored"),
    )
    page = F.floor(F.col("c_custkey") / 500)
    B.table(spark, sf, "customer").groupBy(page.alias("page")).agg(
        F.collect_list(rows).alias("results")
    ).select("results").write.json(path)
    return R.read_result_pages(spark, path, "custkey bigint, segment string, balance double")


@query(
    "s9_xml_observations",
    """SELECT nace_r2 AS series, period, ipi_value AS value FROM v_ind_raw WHERE ipi_value IS NOT NULL""",
)
def s9(spark, sf):
    path = scratch_path(spark, "obs_xml")
    B.ind_raw(spark, sf).select(
        F.col("nace_r2").alias("_SERIES"),
        F.col("period").alias("_TIME_PERIOD"),
        F.coalesce(F.col("ipi_value").cast("string"), F.lit("ND")).alias("_OBS_VALUE"),
    ).write.format("xml").options(rowTag="Obs", rootTag="DataSet").save(path)
    return R.read_observations(spark, path)


@query(
    "s10_safe_table",
    "SELECT n_nationkey, n_name, count(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL",
)
def s10(spark, sf):
    B.table(spark, sf, "nation").createOrReplaceTempView("dim_nation")
    dim = R.safe_table(spark, "dim_nation")
    none = R.safe_table(spark, "dim_that_is_missing")
    assert none is None
    return (
        B.table(spark, sf, "customer")
        .join(dim, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_nationkey", "n_name")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


SQL_TEXT = """
SELECT r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""


@query("s11_adhoc_sql", SQL_TEXT)
def s11(spark, sf):
    names = ("orders", "customer", "nation", "region")
    return R.run_sql(spark, SQL_TEXT, {n: B.table(spark, sf, n) for n in names})


@query(
    "s12_date_range_scan",
    """SELECT CAST(min(l_shipdate) AS DATE) AS date_min, CAST(max(l_shipdate) AS DATE) AS date_max FROM lineitem""",
)
def s12(spark, sf):
    lines = B.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("time"))
    return R.date_range(lines)


NOISE = "(((datediff('day', DATE '1990-01-01', d) * 7919 + place * 104729 + datediff('day', DATE '1990-01-01', d) * place * 31 + {s} * 1299709) % 10007) / 10007.0)"


def noise(salt: int) -> str:
    return NOISE.replace("{s}", str(salt))


@query(
    "s13_synthetic_generator",
    f"""WITH places AS (SELECT g.dept, CAST(c_nationkey + 1 AS BIGINT) AS place, any_value(latitude) AS latitude
  FROM customer JOIN v_geo g ON g.dept = {pad('c_nationkey + 1')} GROUP BY 1, 2),
days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
t AS (SELECT d, dept, place, 15 - (latitude - 43) * 1.2 + 12 * sin(2 * pi() * (dayofyear(d) - 80) / 365.0)
  + ({noise(1)} - 0.5) * 6 AS t FROM places CROSS JOIN days)
SELECT d AS time, dept, {he(f't + 3 + {noise(2)} * 5', 1)} AS temperature_2m_max,
  {he(f't - 3 - {noise(3)} * 5', 1)} AS temperature_2m_min, {he('t', 1)} AS temperature_2m_mean,
  {he(f'greatest(0, {noise(4)} * 9 - 4)', 1)} AS precipitation_sum, {he(f'{noise(5)} * 40', 1)} AS wind_speed_10m_max
FROM t""",
)
def s13(spark, sf):
    """Weather for every department that has customers, over the span of the orders."""
    geo = D.geo_dimension(spark).select("dept", "latitude")
    seen = B.table(spark, sf, "customer").select(
        (F.col("c_nationkey") + 1).cast("bigint").alias("place")
    ).distinct().withColumn("dept", E.pad_code("place"))
    places = seen.join(F.broadcast(geo), "dept")
    span = B.table(spark, sf, "orders").agg(
        F.struct(
            F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
        )
    ).scalar()
    return G.synthetic_weather(places.withColumn("_s", span), F.col("_s.a"), F.col("_s.b"))


MONTHS = "(SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS DATE) AS d FROM orders)"
PLACES = f"(SELECT DISTINCT CAST(c_nationkey + 1 AS BIGINT) AS place, {pad('c_nationkey + 1')} AS dept FROM customer)"


def order_months(spark, sf):
    span = B.table(spark, sf, "orders").agg(F.trunc(F.min("o_orderdate"), "month").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start"))


def customer_places(spark, sf):
    return B.table(spark, sf, "customer").select((F.col("c_nationkey") + 1).cast("bigint").alias("place")).distinct().withColumn("dept", E.pad_code("place"))


def economy_sql() -> str:
    cells = []
    for salt, (name, (level, spread, bounded)) in enumerate(G.ECONOMY_SERIES.items(), 21):
        value = f"{level} + ({noise(salt)} - 0.5) * {2 * spread}"
        cells.append(f"{he(f'greatest(70.0, least(130.0, {value}))' if bounded else value, 1)} AS {name}")
    return f"SELECT strftime(d, '%Y-%m') AS period, {', '.join(cells)} FROM (SELECT d, CAST(0 AS BIGINT) AS place FROM {MONTHS})"


@query("s13_synthetic_economy", economy_sql())
def s13_economy(spark, sf):
    return G.synthetic_economy(order_months(spark, sf))


@query(
    "s13_synthetic_industry",
    f"""WITH c AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {v}, CAST({i} AS BIGINT))" for i, (c, v) in enumerate(G.INDUSTRY_LEVELS.items(), 1))}) t(nace_r2, level, place))
SELECT strftime(d, '%Y-%m') AS period, nace_r2, 'FR' AS geo, {he(f'level + ({noise(31)} - 0.5) * 32.0', 1)} AS ipi_value, 'I21' AS unit, 'SCA' AS s_adj FROM {MONTHS} CROSS JOIN c""",
)
def s13_industry(spark, sf):
    return G.synthetic_industry(order_months(spark, sf))


AT_START = noise(41).replace("datediff('day', DATE '1990-01-01', d)", "0")


@query(
    "s13_synthetic_permits",
    f"""WITH r AS (SELECT d, dept, place, CAST(greatest(1, floor((50.0 + {AT_START} * 450.0) * (1.0 + 0.3 * sin(2 * pi() * (month(d) - 3) / 12.0)) * (0.9 + {noise(42)} * 0.2))) AS BIGINT) AS n FROM {PLACES} CROSS JOIN {MONTHS})
SELECT dept AS "DEP", strftime(d, '%Y-%m') AS "DATE_PRISE_EN_COMPTE", n AS "NB_LGT_TOT_CREES", CAST(floor(n * CAST(0.4 AS DOUBLE)) AS BIGINT) AS "NB_LGT_IND_CREES", CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT) AS "NB_LGT_COLL_CREES", CAST(floor(n * (60.0 + {noise(43)} * 40.0)) AS BIGINT) AS "SURF_TOT_M2" FROM r""",
)
def s13_permits(spark, sf):
    return G.synthetic_permits(customer_places(spark, sf), order_months(spark, sf))


def drawn(salt: int) -> str:
    return noise(salt).replace("place", "(place * 64 + k)")


@query(
    "s13_synthetic_certificates",
    f"""WITH r AS (SELECT dept, place, d, k FROM {PLACES} CROSS JOIN (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders) CROSS JOIN (SELECT CAST(unnest(generate_series(1, 2)) AS BIGINT) AS k))
SELECT 'DPE-' || dept || '-' || strftime(d, '%Y%m%d') || '-' || k AS numero_dpe, d AS date_etablissement_dpe, dept AS code_departement_ban,
  (['A','B','C','D','E','F','G'])[CAST(floor({drawn(11)} * 7) AS INTEGER) + 1] AS etiquette_dpe,
  (['PAC air/eau','PAC air/air','Chaudiere gaz','Chaudiere fioul','Radiateur electrique','Poele bois'])[CAST(floor({drawn(12)} * 6) AS INTEGER) + 1] AS type_generateur_chauffage_principal,
  (['','','Climatisation','PAC reversible'])[CAST(floor({drawn(13)} * 4) AS INTEGER) + 1] AS type_generateur_froid,
  {he(f'15.0 + {drawn(14)} * 150.0', 1)} AS surface_habitable_logement FROM r""",
)
def s13_certificates(spark, sf):
    span = B.table(spark, sf, "orders").agg(F.struct(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))).scalar()
    return G.synthetic_certificates(customer_places(spark, sf).withColumn("_s", span), F.col("_s.a"), F.col("_s.b"), 2)


SAMPLED = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id"}


@query(
    "s14_sample_rows",
    " UNION ALL ".join(f"SELECT * FROM (SELECT '{t}' AS source, CAST({k} AS BIGINT) AS id FROM {t} ORDER BY {k} LIMIT 200)" for t, k in SAMPLED.items()),
)
def s14(spark, sf):
    """The first 200 keys of every table; the limit is the feature."""
    out = None
    for name, key in SAMPLED.items():
        one = R.sample_rows(B.table(spark, sf, name).select(F.col(key).cast("bigint").alias("id")), ["id"])
        one = one.select(F.lit(name).alias("source"), "id")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "s15_reference_dimensions",
    f"""SELECT g.dept, g.dept_name, g.city_ref, g.latitude, g.longitude, r.region_name, g.elevation, count(c_custkey) AS customers
FROM v_geo g JOIN v_region r ON g.region_code = r.region_code
LEFT JOIN customer ON {pad('c_nationkey + 1')} = g.dept GROUP BY ALL""",
)
def s15(spark, sf):
    counted = B.table(spark, sf, "customer").groupBy(
        E.pad_code(F.col("c_nationkey") + 1).alias("dept")
    ).agg(F.count(F.lit(1)).alias("customers"))
    geo = D.geo_dimension(spark).join(F.broadcast(D.region_dimension(spark)), "region_code")
    return geo.join(counted, "dept", "left").select(
        "dept", "dept_name", "city_ref", "latitude", "longitude", "region_name", "elevation",
        F.coalesce("customers", F.lit(0)).alias("customers"),
    )


@query(
    "s16_calendar_dimension",
    f"""WITH m AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS d FROM orders)
SELECT {date_id('d')} AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(quarter(d) AS INTEGER) AS quarter, month(d) IN (1,2,3,10,11,12) AS is_heating, month(d) IN (6,7,8,9) AS is_cooling FROM m""",
)
def s16(spark, sf):
    bounds = B.table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    return D.calendar(bounds, "a", "b")


# --- sinks ---------------------------------------------------------------------------------


@query("k1_write_cleaned", "SELECT * FROM v_wx")
def k1(spark, sf):
    return spark.read.parquet(K.write_table(B.wx(spark, sf), scratch_path(spark, "weather")))


@query("k2_write_panel", "SELECT date_id, dept, nb_dpe_total, temp_mean, ipi_hvac_c28, year FROM v_panel")
def k2(spark, sf):
    path = K.write_table(B.panel(spark, sf), scratch_path(spark, "panel"), ["year"])
    return spark.read.parquet(path).select(
        "date_id", "dept", "nb_dpe_total", "temp_mean", "ipi_hvac_c28", "year"
    )


@query("k3_incremental_save", "SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events")
def k3(spark, sf):
    path = scratch_path(spark, "events_distinct")
    rows = B.table(spark, sf, "events").select("event_type", "user_id", F.col("ts").cast("date").alias("day"))
    K.incremental_save(rows.filter("day <= DATE '2024-01-15'"), path)
    return K.incremental_save(rows.filter("day >= DATE '2024-01-10'"), path)


@query(
    "k4_keyed_upsert",
    f"""SELECT time, dept, temperature_2m_mean FROM (SELECT *, row_number() OVER (PARTITION BY time, dept ORDER BY b DESC, {WX_ORDER}) AS rn
  FROM (SELECT *, 1 AS b FROM v_wx_raw WHERE time < DATE '1999-01-01' UNION ALL SELECT *, 2 FROM v_wx_raw WHERE time >= DATE '1998-01-01')) WHERE rn = 1""",
)
def k4(spark, sf):
    path = scratch_path(spark, "weather_upsert")
    raw = B.wx_raw(spark, sf)
    K.keyed_upsert(raw.filter("time < DATE '1999-01-01'"), path, ["time", "dept"], 1, B.WX_ORDER)
    done = K.keyed_upsert(raw.filter("time >= DATE '1998-01-01'"), path, ["time", "dept"], 2, B.WX_ORDER)
    return done.select("time", "dept", "temperature_2m_mean")


@query(
    "k5_load_table",
    """SELECT 'append' AS mode, count(*) AS rows_loaded FROM orders UNION ALL SELECT 'replace', count(*) FROM customer""",
)
def k5(spark, sf):
    path = scratch_path(spark, "loaded")
    orders = B.table(spark, sf, "orders").select("o_orderkey")
    K.load_frame(orders, path, "replace")
    added = K.load_frame(orders, path, "append")
    held = K.load_frame(B.table(spark, sf, "customer").select("c_custkey"), path, "replace")
    return spark.createDataFrame([("append", added), ("replace", held)], "mode string, rows_loaded bigint")


@query(
    "k6_insert_absent",
    """SELECT c_custkey, 'old' AS origin FROM customer WHERE c_acctbal > 0
UNION ALL SELECT c_custkey, 'new' FROM customer WHERE NOT c_acctbal > 0""",
)
def k6(spark, sf):
    c = B.table(spark, sf, "customer")
    old = c.filter("c_acctbal > 0").select("c_custkey", F.lit("old").alias("origin"))
    return K.insert_absent(c.select("c_custkey", F.lit("new").alias("origin")), old, ["c_custkey"])


@query(
    "k7_refresh_columns",
    """SELECT coalesce(e.date_id, i.date_id) AS date_id, e.confiance_menages, coalesce(i.ipi_hvac_c28, CASE WHEN e.date_id IS NOT NULL THEN -1.0 END::DOUBLE) AS ipi_hvac_c28
FROM v_eco e FULL OUTER JOIN v_ind_wide i ON e.date_id = i.date_id""",
)
def k7(spark, sf):
    from retropanel.operators import cleaning as C
    from retropanel.plans import panel as P

    wide = P.wide_series(C.clean_series(B.eco_raw(spark, sf), ["batch_no"]))
    old = wide.select("date_id", "confiance_menages", F.lit(-1.0).alias("ipi_hvac_c28"))
    new = P.industry_series(C.clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat"))
    return K.refresh_columns(old, new.select("date_id", "ipi_hvac_c28"), ["date_id"])


@query(
    "k8_json_report",
    """SELECT event_type, count(*) AS n, CAST(max(user_id) AS BIGINT) AS max_user FROM events GROUP BY event_type""",
)
def k8(spark, sf):
    report = B.table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("user_id").alias("max_user")
    )
    path = K.write_report(report, scratch_path(spark, "report"))
    return spark.read.schema("event_type string, n bigint, max_user bigint").json(path)


@query(
    "k9_yearly_partitions",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'""",
)
def k9(spark, sf):
    path = scratch_path(spark, "by_year")
    lines = B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day")
    )
    K.write_by_year(lines, path, "day")
    return K.read_by_year(spark, path, "day", "1997-03-01", "1998-02-28").drop("year")
