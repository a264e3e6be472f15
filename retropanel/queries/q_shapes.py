"""Deduplication, reshaping, gaps, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import aggregates as A
from retropanel.operators import dedup as D
from retropanel.operators import gaps as G
from retropanel.operators import joins as J
from retropanel.operators import reshape as R
from retropanel.operators import windows as W
from retropanel.operators.quantiles import exact_quantiles
from retropanel.plans import panel as P
from retropanel.plans import star
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import WX_ORDER, change, date_id, filled, he, interpolated, next_id, pad
from retropanel.session import scratch_path
from retropanel.sources import sinks as K
from retropanel.sources.dimensions import calendar, geo_dimension


# --- deduplication -------------------------------------------------------------------------


@query(
    "d1_duplicate_count",
    """WITH k AS (SELECT count(*) AS n FROM v_wx_raw GROUP BY time, dept)
SELECT CAST(sum(n) AS BIGINT) AS rows_total, count(*) AS keys_distinct, CAST(sum(n - 1) AS BIGINT) AS rows_duplicated FROM k""",
)
def d1(spark, sf):
    return D.duplicate_rows(B.wx_raw(spark, sf), ["time", "dept"])


@query("d2_keep_last", "SELECT time, dept, l_orderkey, temperature_2m_mean FROM v_wx_last")
def d2(spark, sf):
    return D.keep_last(B.wx_raw(spark, sf), ["time", "dept"], B.WX_ORDER).select(
        "time", "dept", "l_orderkey", "temperature_2m_mean"
    )


@query(
    "d3_dedup_then_filter",
    f"""SELECT time, dept, temperature_2m_mean, precipitation_sum FROM (SELECT *, row_number() OVER (PARTITION BY time, dept ORDER BY {WX_ORDER}) AS rn FROM v_wx_raw)
WHERE rn = 1 AND temperature_2m_mean IS NOT NULL AND precipitation_sum > 0""",
)
def d3(spark, sf):
    """One global deduplication before the validity filters, so the result never depends on splits."""
    last = D.keep_last(B.wx_raw(spark, sf), ["time", "dept"], B.WX_ORDER)
    return last.filter("temperature_2m_mean IS NOT NULL AND precipitation_sum > 0").select(
        "time", "dept", "temperature_2m_mean", "precipitation_sum"
    )


@query("d4_exact_distinct", "SELECT DISTINCT text, lang FROM documents")
def d4(spark, sf):
    return D.exact_distinct(B.table(spark, sf, "documents").select("text", "lang"))


@query(
    "d5_interpolate_gaps",
    "SELECT nace_r2, period, " + filled("ipi_value") + " AS ipi_value FROM (SELECT *, "
    + interpolated("ipi_value", "nace_r2", "period")
    + " FROM (SELECT *, row_number() OVER (PARTITION BY nace_r2 ORDER BY period) AS pos FROM v_ind_raw))",
)
def d5(spark, sf):
    return G.interpolate(B.ind_raw(spark, sf), "ipi_value", ["nace_r2"], "period").drop("batch_no")


@query(
    "d6_series_breaks",
    f"""WITH c AS (SELECT nace_r2, date_id, ipi_value, abs({change('ipi_value', 'lag(ipi_value) OVER w')} / 100) AS abs_change
  FROM v_ind WINDOW w AS (PARTITION BY nace_r2 ORDER BY date_id))
SELECT nace_r2, date_id, ipi_value, {he('abs_change', 6)} AS abs_change FROM c WHERE abs_change > 0.01""",
)
def d6(spark, sf):
    from retropanel.operators.cleaning import clean_series

    series = clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat")
    out = G.series_breaks(series, "ipi_value", ["nace_r2"], "date_id", 0.01)
    return out.select("nace_r2", "date_id", "ipi_value", E.half_even("abs_change", 6).alias("abs_change"))


@query("d7_pivot_first", "SELECT date_id, ipi_hvac_c28, ipi_hvac_c2825 FROM v_ind_wide")
def d7(spark, sf):
    from retropanel.operators.cleaning import clean_series

    return P.industry_series(clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat"))


@query(
    "d8_pivot_mean",
    "SELECT dept, " + ", ".join(f"{he(f'avg(nb_installations_pac) FILTER (WHERE date_id % 100 = {m})', 6)} AS month_{m}" for m in range(1, 13)) + " FROM v_facts GROUP BY dept",
)
def d8(spark, sf):
    df = B.facts(spark, sf).withColumn("month", E.month_of("date_id"))
    return E.round_doubles(
        R.pivot_mean(df, ["dept"], "month", "nb_installations_pac", range(1, 13), "month_"), 6
    )


ORDER_MEASURES = ["nb_logements_autorises", "nb_logements_individuels", "surface_autorisee_m2"]


@query(
    "d9_unpivot",
    " UNION ALL ".join(f"SELECT date_id, dept, '{m}' AS measure, {m} AS value FROM v_permit WHERE {m} IS NOT NULL" for m in ORDER_MEASURES),
)
def d9(spark, sf):
    df = P.permit_features(B.permit_raw(spark, sf))
    return R.unpivot_values(df, ["date_id", "dept"], ORDER_MEASURES, "measure", "value")


@query(
    "d10_fill_both_ways",
    """WITH d AS (SELECT time, dept, CASE WHEN day(time) IN (1, 2, 3, 10) THEN NULL ELSE precipitation_sum END AS v FROM v_wx_last),
f AS (SELECT time, dept, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY dept ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY dept ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), (SELECT quantile_cont(v, 0.5) FROM d)) AS v FROM d)
SELECT time, dept, v FROM f""",
)
def d10(spark, sf):
    last = D.keep_last(B.wx_raw(spark, sf), ["time", "dept"], B.WX_ORDER)
    gappy = last.select(
        "time", "dept", F.when(~F.day("time").isin(1, 2, 3, 10), F.col("precipitation_sum")).alias("v")
    )
    median = exact_quantiles(gappy, ["v"], (0.5,)).agg(F.max("q50")).scalar()
    return G.fill_both_ways(gappy, "v", ["dept"], "time", median)


@query(
    "d11_constant_fill",
    """SELECT numero_dpe, coalesce(type_generateur_froid, '') AS type_generateur_froid, surface_habitable_logement FROM v_cert_raw""",
)
def d11(spark, sf):
    df = B.cert_raw(spark, sf).select("numero_dpe", "type_generateur_froid", "surface_habitable_logement")
    return G.fill_constants(df, {"type_generateur_froid": "", "surface_habitable_logement": 0.0})


@query(
    "d12_unstack_means",
    """SELECT event_type, """ + ", ".join(f"{he(f'avg(CAST(floor(value) AS DOUBLE)) FILTER (WHERE dayofweek(ts) = {d})', 6)} AS dow_{d}" for d in range(7)) + " FROM events GROUP BY event_type",
)
def d12(spark, sf):
    df = B.table(spark, sf, "events").select(
        "event_type", F.floor("value").cast("double").alias("v"), (F.dayofweek("ts") - 1).alias("d")
    )
    return E.round_doubles(R.pivot_mean(df, ["event_type"], "d", "v", range(7), "dow_"), 6)


# --- joins ---------------------------------------------------------------------------------


@query(
    "j1_join_weather",
    "SELECT f.date_id, f.dept, nb_dpe_total, temp_mean, hdd_sum FROM v_facts f LEFT JOIN v_wx_month w ON f.date_id = w.date_id AND f.dept = w.dept",
)
def j1(spark, sf):
    weather = P.weather_features(B.wx(spark, sf))
    out = J.left_with_suffix(B.facts(spark, sf), weather, ["date_id", "dept"], "_meteo")
    return out.select("date_id", "dept", "nb_dpe_total", "temp_mean", "hdd_sum")


@query(
    "j2_join_national",
    "SELECT f.date_id, f.dept, confiance_menages, ipi_hvac_c28 FROM v_facts f LEFT JOIN v_eco_wide e ON f.date_id = e.date_id",
)
def j2(spark, sf):
    from retropanel.operators.cleaning import clean_series

    national = P.economic_features(
        P.wide_series(clean_series(B.eco_raw(spark, sf), ["batch_no"])),
        P.industry_series(clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat")),
    )
    return J.left_with_suffix(B.facts(spark, sf), national, ["date_id"], "_eco").select(
        "date_id", "dept", "confiance_menages", "ipi_hvac_c28"
    )


@query(
    "j3_join_permits",
    "SELECT f.date_id, f.dept, nb_logements_autorises, surface_autorisee_m2 FROM v_facts f LEFT JOIN v_permit p ON f.date_id = p.date_id AND f.dept = p.dept",
)
def j3(spark, sf):
    permits = P.permit_features(B.permit_raw(spark, sf))
    return J.left_with_suffix(B.facts(spark, sf), permits, ["date_id", "dept"], "_sitadel").select(
        "date_id", "dept", "nb_logements_autorises", "surface_autorisee_m2"
    )


def bucketed_star(spark, sf):
    """Facts, weather and permits at the panel grain, each stored by (date_id, dept)."""
    parts = {"facts": B.facts(spark, sf), "weather": P.weather_features(B.wx(spark, sf)), "permits": P.permit_features(B.permit_raw(spark, sf))}
    return {name: K.write_bucketed(df, scratch_path(spark, name), ["date_id", "dept"]) for name, df in parts.items()}


@query(
    "k2_bucketed_star",
    """SELECT f.date_id, f.dept, nb_dpe_total, temp_mean, hdd_sum, nb_logements_autorises FROM v_facts f
LEFT JOIN v_wx_month w ON f.date_id = w.date_id AND f.dept = w.dept LEFT JOIN v_permit p ON f.date_id = p.date_id AND f.dept = p.dept""",
)
def k2_bucketed(spark, sf):
    star = bucketed_star(spark, sf)
    out = star["facts"].join(star["weather"], ["date_id", "dept"], "left").join(star["permits"], ["date_id", "dept"], "left")
    return out.select("date_id", "dept", "nb_dpe_total", "temp_mean", "hdd_sum", "nb_logements_autorises")


@query(
    "j4_join_attributes",
    "SELECT f.date_id, f.dept, revenu_median, pct_maisons, altitude FROM v_facts f LEFT JOIN v_attr a ON f.dept = a.dept",
)
def j4(spark, sf):
    attrs = P.area_attributes(B.attr_raw(spark, sf), geo_dimension(spark))
    return J.left_with_suffix(B.facts(spark, sf), attrs, ["dept"], "_ref").select(
        "date_id", "dept", "revenu_median", "pct_maisons", "altitude"
    )


@query(
    "j5_join_geography",
    f"SELECT c_custkey, {pad('c_nationkey + 1')} AS dept, dept_name, city_ref, latitude, longitude FROM customer LEFT JOIN v_geo g ON g.dept = {pad('c_nationkey + 1')}",
)
def j5(spark, sf):
    df = B.table(spark, sf, "customer").select("c_custkey", E.pad_code(F.col("c_nationkey") + 1).alias("dept"))
    return J.with_geography(df, geo_dimension(spark))


@query("j6_outer_economic", "SELECT * FROM v_eco_wide")
def j6(spark, sf):
    from retropanel.operators.cleaning import clean_series

    wide = P.wide_series(clean_series(B.eco_raw(spark, sf), ["batch_no"]))
    industry = P.industry_series(clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat"))
    return E.round_doubles(J.outer_on_period(wide, industry))


FLAGS = ["C25", "C28", "C2825"]


@query(
    "j7_merge_series",
    "SELECT period, " + ", ".join(f"max(ipi_value) FILTER (WHERE nace_r2 = '{f}') AS {f}" for f in FLAGS) + " FROM v_ind_raw GROUP BY period",
)
def j7(spark, sf):
    long = B.ind_raw(spark, sf).select("period", F.col("nace_r2").alias("series"), F.col("ipi_value").alias("value"))
    return J.merge_series(long, FLAGS)


@query(
    "j8_resolve_conflicts",
    """WITH o AS (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
n AS (SELECT o_custkey AS k, max(o_totalprice) AS top, min(o_totalprice) AS low FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT coalesce(o.k, n.k) AS k, o.n, coalesce(n.top, o.top) AS top, n.low FROM o FULL OUTER JOIN n ON o.k = n.k""",
)
def j8(spark, sf):
    o = B.table(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    old = o.filter("o_orderstatus = 'F'").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    )
    new = o.filter("o_orderstatus = 'P'").groupBy("k").agg(
        F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low")
    )
    return J.resolve_conflicts(old, new, ["k"])


FACT_SQL = "CAST({} AS DECIMAL({}))"
STAR_COLUMNS = ["nb_dpe_total", "nb_installations_pac", "nb_installations_clim", "nb_dpe_classe_ab"]


def star_frames(spark, sf):
    geo = geo_dimension(spark)
    fact = star.fact_installations(B.panel(spark, sf), geo)
    bounds = B.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    from retropanel.operators.cleaning import clean_series

    national = P.economic_features(
        P.wide_series(clean_series(B.eco_raw(spark, sf), ["batch_no"])),
        P.industry_series(clean_series(B.ind_raw(spark, sf), ["batch_no"], "eurostat")),
    )
    dims = geo.select("geo_id", F.col("dept").alias("dept_code"), "dept_name", "city_ref")
    return fact, calendar(bounds, "a", "b"), F.broadcast(dims), star.fact_economy(national)


@query(
    "j9_star_join",
    """SELECT p.date_id, p.year, p.month, p.quarter, p.month IN (1,2,3,10,11,12) AS is_heating, p.month IN (6,7,8,9) AS is_cooling,
  p.dept AS dept_code, p.dept_name, p.city_ref, CAST(nb_dpe_total AS INTEGER) AS nb_dpe_total, CAST(nb_installations_pac AS INTEGER) AS nb_installations_pac,
  CAST(temp_mean AS DOUBLE) AS temp_mean, CAST(hdd_sum AS DOUBLE) AS heating_degree_days, CAST(nb_jours_gel AS INTEGER) AS nb_jours_gel,
  confiance_menages, climat_affaires_bat, ipi_hvac_c28 FROM v_panel p""",
)
def j9(spark, sf):
    out = J.star_join(*star_frames(spark, sf))
    exact = ["temp_mean", "heating_degree_days", "confiance_menages", "climat_affaires_bat", "ipi_hvac_c28"]
    return out.withColumns({c: F.col(c).cast("double") for c in exact}).select(
        "date_id", "year", "month", "quarter", "is_heating", "is_cooling", "dept_code", "dept_name", "city_ref",
        "nb_dpe_total", "nb_installations_pac", "temp_mean", "heating_degree_days", "nb_jours_gel",
        "confiance_menages", "climat_affaires_bat", "ipi_hvac_c28",
    )


@query(
    "j10_lookup_inner",
    f"SELECT c_custkey, geo_id FROM customer JOIN v_geo g ON g.dept = {pad('c_nationkey + 1')}",
)
def j10(spark, sf):
    df = B.table(spark, sf, "customer").select("c_custkey", E.pad_code(F.col("c_nationkey") + 1).alias("dept"))
    return df.join(F.broadcast(geo_dimension(spark).select("dept", "geo_id")), "dept").select("c_custkey", "geo_id")


@query(
    "j11_lookup_default",
    f"SELECT c_custkey, {pad('c_nationkey + 1')} AS dept, coalesce(dept_name, 'Dept-' || {pad('c_nationkey + 1')}) AS dept_name FROM customer LEFT JOIN v_geo g ON g.dept = {pad('c_nationkey + 1')}",
)
def j11(spark, sf):
    df = B.table(spark, sf, "customer").select("c_custkey", E.pad_code(F.col("c_nationkey") + 1).alias("dept"))
    return J.lookup_or(df, geo_dimension(spark), "dept", "dept_name", F.concat(F.lit("Dept-"), "dept"))


@query(
    "j12_semi_join",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING sum(o_totalprice) > 2500000)""",
)
def j12(spark, sf):
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    big = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("t")).filter("t > 2500000")
    return J.members(o, big, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "j13_anti_join",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""",
)
def j13(spark, sf):
    used = B.table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return J.absent(B.table(spark, sf, "part").select("p_partkey", "p_name"), used, ["p_partkey"])


@query(
    "j14_month_profile_lookup",
    f"""WITH last AS (SELECT dept, max(date_id) AS d FROM v_wx_month GROUP BY dept),
fut AS (SELECT dept, {next_id('d', 's.k')} AS date_id FROM last, (SELECT unnest(generate_series(1, 12)) AS k) s),
prof AS (SELECT dept, date_id % 100 AS month, avg(temp_mean) AS t FROM v_wx_month GROUP BY 1, 2)
SELECT f.dept, f.date_id, {he('t', 6)} AS temp_mean FROM fut f LEFT JOIN prof p ON f.dept = p.dept AND f.date_id % 100 = p.month""",
)
def j14(spark, sf):
    monthly = P.weather_features(B.wx(spark, sf)).withColumn("month", E.month_of("date_id"))
    profile = monthly.groupBy("dept", "month").agg(E.half_even(F.avg("temp_mean"), 6).alias("temp_mean"))
    last = monthly.groupBy("dept").agg(F.max("date_id").alias("d"))
    steps = last.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(12))))
    future = steps.select("dept", E.shift_month("d", F.col("k")).alias("date_id")).withColumn(
        "month", E.month_of("date_id")
    )
    return future.join(profile, ["dept", "month"], "left").select("dept", "date_id", "temp_mean")


@query(
    "j15_side_by_side",
    """SELECT coalesce(a.k, b.k, c.k) AS feature, a.v AS orders, b.v AS revenue, c.v AS balance FROM
 (SELECT c_mktsegment AS k, CAST(count(o_orderkey) AS DOUBLE) AS v FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) a
 FULL OUTER JOIN (SELECT c_mktsegment AS k, max(o_totalprice) AS v FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) b ON a.k = b.k
 FULL OUTER JOIN (SELECT c_mktsegment AS k, max(c_acctbal) AS v FROM customer GROUP BY 1) c ON a.k = c.k""",
)
def j15(spark, sf):
    o, c = B.table(spark, sf, "orders"), B.table(spark, sf, "customer")
    both = c.join(o, F.col("c_custkey") == F.col("o_custkey")).withColumnRenamed("c_mktsegment", "feature")
    return J.side_by_side(
        {
            "orders": both.groupBy("feature").agg(F.count("o_orderkey").cast("double").alias("v")),
            "revenue": both.groupBy("feature").agg(F.max("o_totalprice").alias("v")),
            "balance": c.groupBy(F.col("c_mktsegment").alias("feature")).agg(F.max("c_acctbal").alias("v")),
        },
        "feature",
        "v",
    )


# --- sorts, limits, top-k ------------------------------------------------------------------


@query("t1_sorted_output", "SELECT date_id, dept, nb_dpe_total FROM v_facts ORDER BY date_id, dept")
def t1(spark, sf):
    return B.facts(spark, sf).select("date_id", "dept", "nb_dpe_total").orderBy("date_id", "dept")


@query("t2_top_entities", "SELECT dept, CAST(sum(nb_installations_pac) AS BIGINT) AS total FROM v_facts GROUP BY dept ORDER BY total DESC, dept LIMIT 10")
def t2(spark, sf):
    totals = B.facts(spark, sf).groupBy("dept").agg(F.sum("nb_installations_pac").alias("total"))
    return totals.orderBy(F.desc("total"), "dept").limit(10)


@query(
    "t3_top_then_filter",
    """SELECT date_id, dept, pct_pac FROM v_facts WHERE dept IN (SELECT dept FROM v_facts GROUP BY dept ORDER BY avg(nb_installations_pac) DESC, dept LIMIT 15)""",
)
def t3(spark, sf):
    df = B.facts(spark, sf)
    top = df.groupBy("dept").agg(F.avg("nb_installations_pac").alias("m")).orderBy(F.desc("m"), "dept").limit(15)
    return J.members(df, top, ["dept"]).select("date_id", "dept", "pct_pac")


@query(
    "t5_best_row",
    """SELECT l_returnflag, spread FROM (SELECT l_returnflag, max(l_extendedprice) - min(l_extendedprice) AS spread FROM lineitem GROUP BY 1) ORDER BY spread, l_returnflag LIMIT 1""",
)
def t5(spark, sf):
    from retropanel.models.metrics import best_row

    table = B.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("spread")
    )
    return best_row(table, "spread", ["l_returnflag"])


@query("t6_ranked_models", f"SELECT event_type AS model, {he('avg(CAST(floor(value) AS DOUBLE))', 6)} AS score FROM events GROUP BY 1 ORDER BY score DESC")
def t6(spark, sf):
    from retropanel.models.metrics import ranked

    table = B.table(spark, sf, "events").groupBy(F.col("event_type").alias("model")).agg(
        E.half_even(F.avg(F.floor("value").cast("double")), 6).alias("score")
    )
    return ranked(table, "score", True)


@query("t7_preview", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 50")
def t7(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", "lang", "n_chars").orderBy("doc_id").limit(50)


# --- set operations ------------------------------------------------------------------------


@query("u0a_union_all", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def u0a(spark, sf):
    c = B.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query(
    "u0b_recursive_calendar",
    f"""WITH RECURSIVE m AS (SELECT date_trunc('month', min(o_orderdate)) AS d FROM orders UNION ALL SELECT d + INTERVAL 1 MONTH FROM m WHERE d + INTERVAL 1 MONTH <= (SELECT max(o_orderdate) FROM orders))
SELECT {date_id('d')} AS date_id, count(o_orderkey) AS orders FROM m LEFT JOIN orders ON {date_id('o_orderdate')} = {date_id('d')} GROUP BY 1""",
)
def u0b(spark, sf):
    o = B.table(spark, sf, "orders")
    months = calendar(o.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")), "a", "b")
    counts = o.groupBy(E.date_id("o_orderdate").alias("date_id")).agg(F.count(F.lit(1)).alias("orders"))
    return months.select("date_id").join(counts, "date_id", "left").na.fill({"orders": 0})


@query(
    "u0c_set_difference",
    f"""SELECT dept, 'missing' AS side FROM v_geo WHERE dept NOT IN (SELECT {pad('c_nationkey + 1')} FROM customer)
UNION ALL SELECT DISTINCT {pad('c_nationkey + 1')}, 'extra' FROM customer WHERE {pad('c_nationkey + 1')} NOT IN (SELECT dept FROM v_geo)""",
)
def u0c(spark, sf):
    want = geo_dimension(spark).select("dept")
    have = B.table(spark, sf, "customer").select(E.pad_code(F.col("c_nationkey") + 1).alias("dept")).distinct()
    missing = J.absent(want, have, ["dept"]).withColumn("side", F.lit("missing"))
    return missing.unionByName(J.absent(have, F.broadcast(want), ["dept"]).withColumn("side", F.lit("extra")))


@query(
    "u0d_required_columns",
    """SELECT 'city' AS column_missing, count(*) AS n_rows FROM v_wx_raw UNION ALL SELECT 'elevation', count(*) FROM v_wx_raw""",
)
def u0d(spark, sf):
    df = B.wx_raw(spark, sf)
    lost = E.missing(df, ["time", "dept", "city", "elevation", "temperature_2m_mean"])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.lit(c) for c in lost])).alias("column_missing"), "n_rows"
    )
