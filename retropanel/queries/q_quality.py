"""Cleaning previews, quality reports, constraints, lineage and the streaming twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import aggregates as A
from retropanel.operators import cleaning as C
from retropanel.operators import quality as Q
from retropanel.operators import stats as T
from retropanel.operators.dedup import keep_last
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import AS_OF, START, date_id, he, next_id, pad, pct
from retropanel.session import materialize, scratch_path
from retropanel.sources import sinks as K
from retropanel.sources.dimensions import departments_for_scope, geo_dimension
from retropanel.streaming import incremental as I

BAD_DAY = f"NOT CAST(date_etablissement_dpe AS DATE) BETWEEN DATE '{START}' AND DATE '{AS_OF}'"
BAD_LABEL = "etiquette_dpe NOT IN ('A','B','C','D','E','F','G')"
BAD_DEPT = f"{pad('code_departement_ban')} NOT IN (SELECT dept FROM v_geo)"
CLIPS = "CAST(surface_habitable_logement NOT BETWEEN 5 AND 1000 AS INTEGER) + CAST(conso_5_usages_par_m2_ep > 1000 AS INTEGER) + CAST(cout_total_5_usages > 50000 AS INTEGER)"


def impact(source: str, table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{r}' AS rule, CAST({e} AS BIGINT) AS rows_affected, {pct(e, 'count(*)', 1)} AS pct FROM {table}"
        for r, e in rules.items()
    )


@query(
    "q1_cleaning_preview",
    "SELECT * FROM ("
    + impact(
        "dpe",
        "v_cert_raw",
        {
            "remove_duplicates": "count(*) - count(DISTINCT numero_dpe)",
            "filter_invalid_dates": f"count(*) FILTER (WHERE {BAD_DAY})",
            "filter_invalid_labels": f"count(*) FILTER (WHERE {BAD_LABEL})",
            "clip_outliers": f"sum({CLIPS})",
            "filter_invalid_depts": f"count(*) FILTER (WHERE {BAD_DEPT})",
        },
    )
    + ") UNION ALL SELECT * FROM ("
    + impact(
        "weather",
        "v_wx_raw",
        {
            "remove_duplicates": "count(*) - count(DISTINCT (time, dept))",
            "remove_nan_temps": "count(*) FILTER (WHERE temperature_2m_mean IS NULL)",
            "clip_outliers": "count(*) FILTER (WHERE temperature_2m_mean NOT BETWEEN -30 AND 50) + count(*) FILTER (WHERE temperature_2m_max NOT BETWEEN -30 AND 50) + count(*) FILTER (WHERE temperature_2m_min NOT BETWEEN -30 AND 50) + count(*) FILTER (WHERE precipitation_sum > 300) + count(*) FILTER (WHERE wind_speed_10m_max > 200)",
        },
    )
    + ") UNION ALL SELECT * FROM ("
    + impact(
        "eurostat",
        "v_ind_raw",
        {
            "remove_duplicates": "count(*) - count(DISTINCT (period, nace_r2))",
            "filter_non_monthly": "count(*) FILTER (WHERE NOT regexp_matches(period, '^\\d{4}-\\d{2}$'))",
        },
    )
    + ") UNION ALL SELECT * FROM ("
    + impact(
        "insee",
        "v_eco_raw",
        {
            "remove_duplicates": "count(*) - count(DISTINCT period)",
            "filter_non_monthly": "count(*) FILTER (WHERE NOT regexp_matches(period, '^\\d{4}-\\d{2}$'))",
        },
    )
    + ")",
)
def q1(spark, sf):
    certs, weather = B.cert_raw(spark, sf), B.wx_raw(spark, sf)
    industry, economy = B.ind_raw(spark, sf), B.eco_raw(spark, sf)
    plans = [
        (certs, C.certificate_source(certs, B.CERT_ORDER, departments_for_scope("FR"), START, AS_OF)),
        (weather, C.weather_source(weather, B.WX_ORDER)),
        (industry, C.series_source(industry, ["batch_no"], "eurostat")),
        (economy, C.series_source(economy, ["batch_no"], "insee")),
    ]
    out = None
    for df, source in plans:
        one = C.preview(df, source)
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "q2_cleaning_stats",
    f"""SELECT count(*) AS rows_in, CAST(0 AS BIGINT) AS duplicates_removed, count(*) FILTER (WHERE {BAD_DAY}) AS date_invalid_removed,
  count(*) FILTER (WHERE NOT ({BAD_DAY}) AND {BAD_LABEL}) AS label_invalid_removed,
  CAST(coalesce(sum({CLIPS}) FILTER (WHERE NOT ({BAD_DAY}) AND NOT ({BAD_LABEL})), 0) AS BIGINT) AS values_clipped,
  count(*) FILTER (WHERE NOT ({BAD_DAY}) AND NOT ({BAD_LABEL}) AND {BAD_DEPT}) AS dept_invalid_removed, (SELECT count(*) FROM v_cert) AS rows_out FROM v_cert_raw""",
)
def q2(spark, sf):
    return C.certificate_stats(B.cert_raw(spark, sf), B.CERT_ORDER, departments_for_scope("FR"), START, AS_OF)


WX_COLUMNS = {"time": "date", "dept": "string", "temperature_2m_mean": "double", "precipitation_sum": "double"}


@query(
    "q3_null_report",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH n AS (SELECT count(*) FILTER (WHERE {c} IS NULL) AS k, {he(f'1e2 * count(*) FILTER (WHERE {c} IS NULL) / count(*)', 2)} AS p FROM v_wx_raw)
SELECT '{c}' AS "column", k AS null_count, p AS null_pct, '{t}' AS dtype, CASE WHEN p > 50 THEN 'CRITICAL' WHEN p > 5 THEN 'WARNING' WHEN p > 0 THEN 'OK' ELSE 'CLEAN' END AS severity FROM n)"""
        for c, t in WX_COLUMNS.items()
    ),
)
def q3(spark, sf):
    return T.null_report(B.wx_raw(spark, sf).select(*WX_COLUMNS))


@query(
    "q4_nulls_by_source",
    """WITH u AS (SELECT count(*) FILTER (WHERE temp_mean IS NULL) AS t, count(*) FILTER (WHERE hdd_sum IS NULL) AS h, count(*) FILTER (WHERE ipi_hvac_c28 IS NULL) AS i,
 count(*) FILTER (WHERE confiance_menages IS NULL) AS c, count(*) FILTER (WHERE nb_dpe_total IS NULL) AS n, count(*) FILTER (WHERE month IS NULL) AS m, count(*) FILTER (WHERE climat_affaires_bat IS NULL) AS b FROM v_panel)
SELECT 'Weather (Open-Meteo)' AS source, CAST(2 AS BIGINT) AS cols_total, CAST((t > 0)::INT + (h > 0)::INT AS BIGINT) AS cols_with_null, t + h AS null_cells FROM u
UNION ALL SELECT 'Eurostat (industry)', 1, CAST((i > 0)::INT AS BIGINT), i FROM u
UNION ALL SELECT 'INSEE (economic)', 2, CAST((c > 0)::INT + (b > 0)::INT AS BIGINT), c + b FROM u
UNION ALL SELECT 'DPE (ADEME)', 1, CAST((n > 0)::INT AS BIGINT), n FROM u
UNION ALL SELECT 'Other / Identifier', 1, CAST((m > 0)::INT AS BIGINT), m FROM u""",
)
def q4(spark, sf):
    names = ["temp_mean", "hdd_sum", "ipi_hvac_c28", "confiance_menages", "climat_affaires_bat", "nb_dpe_total", "month"]
    return Q.nulls_by_source(B.panel(spark, sf).select(*names))


@query(
    "q5_entity_coverage",
    f"""WITH c AS (SELECT {pad('c_nationkey + 1')} AS dept, count(*) AS n FROM customer GROUP BY 1)
SELECT coalesce(g.dept, c.dept) AS dept, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'missing' WHEN g.dept IS NULL THEN 'extra' ELSE 'present' END AS status
FROM v_geo g FULL OUTER JOIN c ON g.dept = c.dept""",
)
def q5(spark, sf):
    have = B.table(spark, sf, "customer").select(E.pad_code(F.col("c_nationkey") + 1).alias("dept"))
    return Q.entity_coverage(have, geo_dimension(spark))


@query(
    "q5_coverage_summary",
    f"""WITH c AS (SELECT {pad('c_nationkey + 1')} AS dept, count(*) AS n FROM customer GROUP BY 1), a AS (SELECT g.dept AS g, c.dept AS c, n FROM v_geo g FULL OUTER JOIN c ON g.dept = c.dept)
SELECT count(*) FILTER (WHERE c IS NULL) AS n_missing, count(*) FILTER (WHERE g IS NULL) AS n_extra, min(n) AS rows_min, max(n) AS rows_max, {he('avg(n)', 4)} AS rows_mean FROM a""",
)
def q5_summary(spark, sf):
    return Q.coverage_summary(q5(spark, sf))


@query(
    "q6_temporal_coverage",
    """WITH p AS (SELECT dept, count(DISTINCT date_id) AS n_months FROM v_facts GROUP BY dept), t AS (SELECT count(DISTINCT date_id) AS e FROM v_facts)
SELECT dept, n_months, e AS expected_months FROM p, t WHERE n_months < e""",
)
def q6(spark, sf):
    return Q.incomplete_entities(B.facts(spark, sf))


@query(
    "q6_period_gaps",
    f"""WITH d AS (SELECT DISTINCT dept, date_id FROM v_facts), l AS (SELECT dept, date_id, lead(date_id) OVER (PARTITION BY dept ORDER BY date_id) AS nx FROM d)
SELECT dept, date_id AS gap_after, nx AS gap_before FROM l WHERE nx <> {next_id('date_id')}""",
)
def q6_gaps(spark, sf):
    return Q.period_gaps(B.facts(spark, sf), ["dept"])


@query(
    "q7_freshness",
    f"""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS date_min, CAST(max(o_orderdate) AS DATE) AS date_max FROM orders)
SELECT date_min, date_max, CAST(datediff('day', date_min, date_max) AS INTEGER) AS span_days, {he("datediff('day', date_min, date_max) / 30.44", 2)} AS span_months,
  CAST(datediff('day', date_max, DATE '2001-10-01') AS INTEGER) AS age_days, CASE WHEN datediff('day', date_max, DATE '2001-10-01') <= 30 THEN 'UP TO DATE' WHEN datediff('day', date_max, DATE '2001-10-01') <= 90 THEN 'AGING' ELSE 'STALE' END AS freshness FROM b""",
)
def q7(spark, sf):
    return Q.freshness(B.table(spark, sf, "orders"), "o_orderdate", "2001-10-01")


@query(
    "q8_validation_checks",
    f"""WITH a AS (SELECT count(*) AS n, 1e2 * count(*) FILTER (WHERE temperature_2m_mean IS NULL) / count(*) AS nt, min(precipitation_sum) AS p0, max(precipitation_sum) AS p1, min(temperature_2m_mean) AS t0, max(temperature_2m_mean) AS t1 FROM v_wx_raw),
c AS (SELECT 'null_share:time' AS "check", CAST(0 AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS low, CAST(5 AS DOUBLE) AS high, 'warning' AS severity FROM a
UNION ALL SELECT 'null_share:temperature_2m_mean', nt, NULL, 5, 'warning' FROM a
UNION ALL SELECT 'min:precipitation_sum', p0, -30, NULL, 'warning' FROM a UNION ALL SELECT 'max:precipitation_sum', p1, NULL, 300, 'warning' FROM a
UNION ALL SELECT 'min:temperature_2m_mean', t0, -30, NULL, 'warning' FROM a UNION ALL SELECT 'max:temperature_2m_mean', t1, NULL, 300, 'warning' FROM a
UNION ALL SELECT 'rows', CAST(n AS DOUBLE), 1000, NULL, 'error' FROM a UNION ALL SELECT 'missing_columns', 1, NULL, 0, 'error' FROM a)
SELECT 'weather' AS source, "check", {he('value', 4)} AS value, low, high, severity, CASE WHEN value < low OR value > high THEN severity ELSE 'pass' END AS status FROM c""",
)
def q8(spark, sf):
    df = B.wx_raw(spark, sf)
    checks = Q.null_share_checks(df.select("time", "temperature_2m_mean")) + Q.range_checks(["precipitation_sum", "temperature_2m_mean"], -30, 300) + [Q.rows_check(1000)]
    out = Q.validate(df, "weather", ["time", "dept", "city", "temperature_2m_mean"], checks)
    return out.withColumn("value", E.half_even("value", 4))


def check_sql(source: str, frame: str, checks: list[tuple[str, str, str, str, str]]) -> str:
    """One SELECT per check (name, aggregate, low, high, severity) over a view."""
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", CAST(({v}) AS DOUBLE) AS value, CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high, '{sev}' AS severity FROM {frame}"
        for n, v, lo, hi, sev in checks
    )
    return f"SELECT '{source}' AS source, \"check\", {he('value', 4)} AS value, low, high, severity, CASE WHEN value < low OR value > high THEN severity ELSE 'pass' END AS status FROM ({rows})"


def share(column: str) -> tuple[str, str, str, str, str]:
    return (f"null_share:{column}", f"1e2 * count(*) FILTER (WHERE {column} IS NULL) / count(*)", "NULL", "5", "warning")


def source_report(df, source):
    return Q.validate(df, source, *Q.source_checks(df, source)).withColumn("value", E.half_even("value", 4))


WEATHER_COLUMNS = ["time", "dept", "temperature_2m_mean", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max"]


@query("q8_weather_checks", check_sql("weather", "v_wx_raw", [*map(share, WEATHER_COLUMNS), ("missing_columns", "max(1)", "NULL", "0", "error")]))
def q8_weather(spark, sf):
    return source_report(B.wx_raw(spark, sf).select(*WEATHER_COLUMNS), "weather")


ORDER_SERIES = {"confiance_menages": "o_totalprice / 2500", "climat_affaires_industrie": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 2500 END", "opinion_achats_importants": "o_totalprice / 250"}


@query(
    "q8_economy_checks",
    check_sql(
        "economy",
        "(SELECT " + ", ".join(f"{v} AS {c}" for c, v in ORDER_SERIES.items()) + " FROM orders)",
        [("series", "max(3)", "3", "NULL", "error")]
        + [(f"nulls:{c}", f"count(*) FILTER (WHERE {c} IS NULL)", "NULL", "0", "warning") for c in ORDER_SERIES]
        + [x for c in ORDER_SERIES for x in ((f"min:{c}", f"min({c})", "-200", "NULL", "warning"), (f"max:{c}", f"max({c})", "NULL", "500", "warning"))]
        + [("missing_columns", "max(0)", "NULL", "0", "error")],
    ),
)
def q8_economy(spark, sf):
    o = B.table(spark, sf, "orders")
    return source_report(o.select(F.col("o_orderdate").cast("string").alias("period"), *[F.expr(v).alias(c) for c, v in ORDER_SERIES.items()]), "economy")


@query(
    "q8_industry_checks",
    check_sql(
        "industry",
        "(SELECT l_returnflag AS nace_r2, l_extendedprice / 500 AS ipi_value FROM lineitem)",
        [("codes", "count(DISTINCT nace_r2)", "1", "NULL", "error"), ("min:ipi_value", "min(ipi_value)", "0", "NULL", "warning"), ("max:ipi_value", "max(ipi_value)", "NULL", "300", "warning"), ("missing_columns", "max(0)", "NULL", "0", "error")],
    ),
)
def q8_industry(spark, sf):
    l = B.table(spark, sf, "lineitem")
    return source_report(l.select(F.col("l_shipdate").cast("string").alias("period"), F.col("l_returnflag").alias("nace_r2"), (F.col("l_extendedprice") / 500).alias("ipi_value")), "industry")


@query(
    "q8_permit_checks",
    check_sql(
        "permits",
        "(SELECT l_quantity AS q FROM lineitem)",
        [("rows", "count(*)", "100", "NULL", "warning"), ("min:NB_LGT_TOT_CREES", "min(q)", "0", "NULL", "warning"), ("missing_columns", "max(0)", "NULL", "0", "error")],
    ),
)
def q8_permits(spark, sf):
    return source_report(B.permit_raw(spark, sf), "permits")


@query(
    "q8_certificate_checks",
    check_sql(
        "certificates",
        "v_cert_raw",
        [("invalid_date_share", "1e2 * count(*) FILTER (WHERE TRY_CAST(date_etablissement_dpe AS DATE) IS NULL) / count(*)", "NULL", "5", "warning"), ("labels", "count(DISTINCT etiquette_dpe)", "1", "NULL", "warning"), ("missing_columns", "max(0)", "NULL", "0", "warning")],
    ),
)
def q8_certificates(spark, sf):
    return source_report(B.cert_raw(spark, sf), "certificates")


@query("q9_stage_gates", "SELECT 'events' AS source, 'rows' AS \"check\", CAST(count(*) AS DOUBLE) AS value FROM events")
def q9(spark, sf):
    df = B.table(spark, sf, "events")
    checks = Q.validate(df, "events", ["event_id", "ts"], [Q.rows_check(10)])
    Q.gate(checks)
    return checks.filter("check = 'rows'").select("source", "check", "value")


@query(
    "q10_alerts",
    f"""WITH m AS (SELECT 'weather_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM v_wx_raw UNION ALL SELECT 'certificate_rows', CAST(count(*) AS DOUBLE) FROM v_cert_raw
 UNION ALL SELECT 'panel_rows', CAST(count(*) AS DOUBLE) FROM v_facts UNION ALL SELECT 'panel_departments', CAST(count(DISTINCT dept) AS DOUBLE) FROM v_facts
 UNION ALL SELECT 'feature_null_pct', {he('1e2 * count(*) FILTER (WHERE temperature_2m_mean IS NULL) / count(*)', 4)} FROM v_wx_raw)
SELECT metric, value, CASE metric WHEN 'weather_rows' THEN CASE WHEN value < 100000 THEN 'CRITICAL' WHEN value < 200000 THEN 'WARNING' ELSE 'OK' END
 WHEN 'certificate_rows' THEN CASE WHEN value < 100000 THEN 'CRITICAL' WHEN value < 500000 THEN 'WARNING' ELSE 'OK' END
 WHEN 'panel_rows' THEN CASE WHEN value < 500 THEN 'CRITICAL' WHEN value < 2000 THEN 'WARNING' ELSE 'OK' END
 WHEN 'panel_departments' THEN CASE WHEN value < 50 THEN 'CRITICAL' WHEN value < 90 THEN 'WARNING' ELSE 'OK' END
 ELSE CASE WHEN value > 40 THEN 'CRITICAL' WHEN value > 15 THEN 'WARNING' ELSE 'OK' END END AS level FROM m""",
)
def q10(spark, sf):
    rows = lambda df, n: df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(n).alias("metric"), "value")
    weather, facts = B.wx_raw(spark, sf), B.facts(spark, sf)
    nulls = weather.agg(
        E.half_even(F.count_if(F.col("temperature_2m_mean").isNull()) * 100.0 / F.count(F.lit(1)), 4).alias("value")
    ).select(F.lit("feature_null_pct").alias("metric"), "value")
    metrics = (
        rows(weather, "weather_rows")
        .unionByName(rows(B.cert_raw(spark, sf), "certificate_rows"))
        .unionByName(rows(facts, "panel_rows"))
        .unionByName(rows(facts.select("dept").distinct(), "panel_departments"))
        .unionByName(nulls)
    )
    return Q.alerts(metrics, Q.alert_rules(spark))


@query(
    "q11_constraints",
    f"""SELECT 'unique_period_entity' AS "constraint", count(*) AS violations FROM (SELECT 1 FROM v_wx_raw GROUP BY time, dept HAVING count(*) > 1)
UNION ALL SELECT 'fk_department', count(*) FROM v_wx_raw WHERE {pad('dept')} NOT IN (SELECT dept FROM v_geo)
UNION ALL SELECT 'month_range', count(*) FROM v_wx_raw WHERE NOT month(time) BETWEEN 1 AND 12
UNION ALL SELECT 'year_range', count(*) FROM v_wx_raw WHERE NOT year(time) BETWEEN 1996 AND 2030""",
)
def q11(spark, sf):
    df = B.wx_raw(spark, sf).withColumn("dept", E.pad_code("dept"))
    return Q.constraint_report(
        df,
        ("unique_period_entity", ["time", "dept"]),
        {"fk_department": (geo_dimension(spark), "dept")},
        {"month_range": F.month("time").between(1, 12), "year_range": F.year("time").between(1996, 2030)},
    )


@query(
    "q12_lineage",
    f"""SELECT 'clean' AS stage, (SELECT count(*) FROM v_wx_raw) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM v_wx_raw) - count(*) AS rows_removed,
 {he('1e2 * (count(time) + count(dept) + count(temperature_2m_mean) + count(hdd)) / (4 * count(*))', 2)} AS completeness_pct FROM v_wx""",
)
def q12(spark, sf):
    make = lambda raw: C.clean_weather(raw, B.WX_ORDER).select("time", "dept", "temperature_2m_mean", "hdd")
    _, record = Q.record_while_written("clean", B.wx_raw(spark, sf), make, materialize)
    path = K.write_report(record, scratch_path(spark, "lineage"))
    schema = "stage string, rows_before bigint, rows_after bigint, rows_removed bigint, completeness_pct double"
    return spark.read.schema(schema).json(path)


@query(
    "q13_manifest_changes",
    """WITH p AS (SELECT source, count(*) AS size, max(doc_id) AS hash FROM documents WHERE lang = 'en' GROUP BY 1), c AS (SELECT source, count(*) AS size, max(doc_id) AS hash FROM documents GROUP BY 1)
SELECT c.source AS name, c.hash, c.size, CASE WHEN p.source IS NULL THEN 'new' ELSE 'modified' END AS reason FROM c LEFT JOIN p ON c.source = p.source
WHERE c.hash IS DISTINCT FROM p.hash OR c.size IS DISTINCT FROM p.size""",
)
def q13(spark, sf):
    docs = B.table(spark, sf, "documents")
    manifest = lambda df: df.groupBy(F.col("source").alias("name")).agg(
        F.max("doc_id").alias("hash"), F.count(F.lit(1)).alias("size")
    )
    return Q.manifest_changes(manifest(docs.filter("lang = 'en'")), manifest(docs))


# --- streaming twins -----------------------------------------------------------------------


def event_files(spark, sf):
    """Events as a folder of daily files, the input a file stream sees."""
    path = scratch_path(spark, "event_files")
    events = B.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(F.col("ts").cast("date")).write.parquet(path)
    return path, events.schema


@query(
    "u1_stream_upsert",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def u1(spark, sf):
    path, schema = event_files(spark, sf)
    target, mark = scratch_path(spark, "latest"), scratch_path(spark, "marks")
    each = I.upsert_latest(target, ["user_id", "event_type"], ["ts", "event_id"])
    I.run_available(I.file_stream(spark, path, schema, 4), mark, each)
    return K.read_merged(spark, target).select("user_id", "event_type", "event_id", "value")


#: Rows of an arriving file at most.
FILE_ROWS = 1 << 19


def arriving(rows, arrival, path, slices=8, file_rows=FILE_ROWS):
    """Files that reach a folder one after another, by ranges of the date ``arrival``; the column goes.

    A range is one file: of several, a stream that takes some files at a time could see the range's end before
    its beginning. Ranges of over ``file_rows`` rows are parted further; a day that has more is several files.
    """
    day = F.datediff(arrival, F.lit("1970-01-01"))
    dated = rows.withColumn("day__", day).filter(F.col("day__").isNotNull())
    days = [tuple(r) for r in dated.groupBy("day__").count().orderBy("day__").collect()]  # the calendar
    most, cuts, files, held = min(-(-sum(n for _, n in days) // slices), file_rows), [], [1], 0
    for d, n in days:
        if held and held + n > most:
            files, held = [*files, 1], 0
        files[-1], held = max(files[-1], -(-n // file_rows)), held + n
        cuts.append((d, len(files) - 1, files[-1]))
    cuts = rows.sparkSession.createDataFrame(cuts, "day__ int, slice__ int, files__ int")
    salt = F.pmod(F.xxhash64(*rows.columns), "files__")
    ranges = dated.join(F.broadcast(cuts), "day__").repartition("slice__", salt).select(*rows.columns, "slice__")
    ranges = materialize(ranges, "slice__")
    for k, n in enumerate(files):
        part = ranges.filter(F.col("slice__") == k).drop("slice__", arrival)
        (part.coalesce(1) if n == 1 else part.repartition(n)).write.mode("append").parquet(path)
    return path


@query("u1_stream_distinct", "SELECT event_id, user_id, event_type, CAST(floor(value) AS BIGINT) AS units FROM events")
def u1_distinct(spark, sf):
    """Every event arrives twice: a second set of files holds each day again, a day later."""
    events = B.table(spark, sf, "events").select("event_id", "user_id", "event_type", F.floor("value").alias("units"), F.col("ts").cast("timestamp").alias("ts"))
    path, out, mark = (scratch_path(spark, n) for n in ("twice", "distinct", "marks"))
    day = F.col("ts").cast("date")
    both = events.withColumn("arrival", day).unionByName(events.withColumn("arrival", F.date_add(day, 1)))
    rows = I.distinct_within(I.file_stream(spark, arriving(both, "arrival", path), events.schema, 3), ["event_id"], "ts", "7 days")
    I.append_available(rows, out, mark)
    return spark.read.schema(events.schema).parquet(out).drop("ts")


LATE = 40
MONTHS_CLOSED = f"(SELECT max(date_etablissement_dpe) FROM v_cert) - INTERVAL {LATE} DAY"


@query(
    "u2_stream_months",
    f"""SELECT date_id, code_departement_ban AS dept, count(*) AS n, CAST(sum(CAST(is_pac AS BIGINT)) AS BIGINT) AS is_pac, CAST(sum(CAST(is_clim AS BIGINT)) AS BIGINT) AS is_clim FROM v_cert
WHERE date_trunc('month', date_etablissement_dpe) + INTERVAL 1 MONTH < {MONTHS_CLOSED} GROUP BY 1, 2""",
)
def u2_months(spark, sf):
    """Certificates arrive up to 30 days late, and every file of a tenth of them arrives again."""
    rows = B.cert(spark, sf).select("numero_dpe", F.col("code_departement_ban").alias("dept"), F.col("date_etablissement_dpe").cast("timestamp").alias("ts"), "is_pac", "is_clim")
    path, out, marks = scratch_path(spark, "arriving"), scratch_path(spark, "months"), scratch_path(spark, "marks")
    once = materialize(rows.withColumn("arrival", F.date_add(F.col("ts").cast("date"), F.pmod(F.col("numero_dpe"), F.lit(30)).cast("int"))))
    again = once.filter(F.col("numero_dpe") % 10 == 3).withColumn("arrival", F.date_add("arrival", 5))
    stream = I.distinct_within(I.file_stream(spark, arriving(once.unionByName(again), "arrival", path), rows.schema, 2), ["numero_dpe"], "ts", f"{LATE} days")
    I.append_available(I.closed_months(stream, "ts", "dept", ["is_pac", "is_clim"]), out, marks)
    return spark.read.schema("date_id int, dept string, n bigint, is_pac bigint, is_clim bigint").parquet(out)


@query(
    "u2_stream_counts",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(floor(value)) AS BIGINT) AS total FROM events GROUP BY 1, 2",
)
def u2(spark, sf):
    path, schema = event_files(spark, sf)
    target, mark = scratch_path(spark, "counts"), scratch_path(spark, "marks")
    count = lambda df: df.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("value")).alias("total")
    )

    def merge(parts):
        stacked = parts[0]
        for p in parts[1:]:
            stacked = stacked.unionByName(p)
        return stacked.groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    I.run_available(I.file_stream(spark, path, schema, 4), mark, I.accumulate_counts(target, count, ["day", "event_type"], merge))
    return K.read_merged(spark, target)


@query(
    "u2_stream_windows",
    """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(floor(value)) AS BIGINT) AS total FROM events
WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2""",
)
def u2_windows(spark, sf):
    """Watermarked tumbling windows: days still open at the end of the input are not emitted."""
    path, schema = event_files(spark, sf)
    out, mark = scratch_path(spark, "windows"), scratch_path(spark, "marks")
    stream = I.file_stream(spark, path, schema).withColumn("units", F.floor("value"))
    query_ = (
        I.daily_windows(stream, "ts", ["event_type"], "units")
        .writeStream.outputMode("append")
        .option("checkpointLocation", mark)
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    query_.awaitTermination()
    return spark.read.schema("day date, event_type string, n bigint, total bigint").parquet(out)


@query(
    "u3_resume_unseen",
    "SELECT count(*) AS n FROM events UNION ALL SELECT 0 UNION ALL SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))",
)
def u3(spark, sf):
    """A second run over the same files finds nothing; entities without rows are still to do."""
    path, schema = event_files(spark, sf)
    mark = scratch_path(spark, "marks")
    seen = []
    each = lambda df, number: seen.append(df.count())
    I.run_available(I.file_stream(spark, path, schema), mark, each)
    first = sum(seen)
    seen.clear()
    I.run_available(I.file_stream(spark, path, schema), mark, each)
    left = I.unseen_entities(
        B.table(spark, sf, "customer").select("c_custkey"),
        B.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"],
    )
    counts = spark.createDataFrame([(first,), (sum(seen),)], "n bigint")
    return counts.unionByName(left.agg(F.count(F.lit(1)).alias("n")))


@query("u4_trigger_refresh", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def u4(spark, sf):
    path, schema = event_files(spark, sf)
    mark, out = scratch_path(spark, "marks"), scratch_path(spark, "refreshed")

    def refresh():
        spark.read.schema(schema).parquet(path).groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n")
        ).write.mode("overwrite").parquet(out)

    assert I.refresh_if_new(I.file_stream(spark, path, schema), mark, refresh)
    assert not I.refresh_if_new(I.file_stream(spark, path, schema), mark, refresh)
    return spark.read.parquet(out)
