"""Aggregations and windows over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.operators import aggregates as A
from retropanel.operators import gaps as G
from retropanel.operators import joins as J
from retropanel.operators import stats as T
from retropanel.operators import windows as W
from retropanel.operators.quantiles import exact_quantiles
from retropanel.plans import features as P
from retropanel.plans import panel as PL
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import change, clip, date_id, he, next_id, pad, pct
from retropanel.session import materialize
from retropanel.sources.dimensions import geo_dimension

COUNTS = "nb_dpe_total, nb_installations_pac, nb_installations_clim, nb_dpe_classe_ab"


@query("a1_event_counts", f"SELECT date_id, dept, {COUNTS} FROM v_facts")
def a1(spark, sf):
    return A.event_counts(B.cert(spark, sf).withColumnRenamed("code_departement_ban", "dept"))


@query("a2_partial_final", f"SELECT date_id, dept, {COUNTS} FROM v_facts")
def a2(spark, sf):
    """Counts of separately ingested labels, merged."""
    df = B.cert(spark, sf).withColumnRenamed("code_departement_ban", "dept")
    parts = [A.event_counts(df.filter(c)) for c in (F.col("etiquette_dpe") < "D", F.col("etiquette_dpe") >= "D")]
    return A.merge_counts(parts)


@query("a3_ratios", "SELECT date_id, dept, pct_pac, pct_clim, pct_classe_ab FROM v_facts")
def a3(spark, sf):
    return B.facts(spark, sf).select("date_id", "dept", "pct_pac", "pct_clim", "pct_classe_ab")


@query("a4_monthly_weather", "SELECT * FROM v_wx_month")
def a4(spark, sf):
    return PL.weather_features(B.wx(spark, sf))


@query("a5_sum_measures", "SELECT * FROM v_permit")
def a5(spark, sf):
    return PL.permit_features(B.permit_raw(spark, sf))


@query("a6_rates", "SELECT date_id, dept, pac_per_1000_logements, clim_per_1000_logements FROM v_panel")
def a6(spark, sf):
    attrs = PL.area_attributes(B.attr_raw(spark, sf), geo_dimension(spark))
    return A.rate_columns(B.facts(spark, sf).join(attrs, "dept", "left")).select(
        "date_id", "dept", "pac_per_1000_logements", "clim_per_1000_logements"
    )


@query(
    "a7_national_totals",
    f"SELECT date_id, CAST(sum(nb_dpe_total) AS BIGINT) AS nb_dpe_total_sum, CAST(sum(nb_installations_pac) AS BIGINT) AS nb_installations_pac_sum, {he('avg(pct_pac)', 6)} AS pct_pac_mean FROM v_facts GROUP BY 1",
)
def a7(spark, sf):
    plan = {"nb_dpe_total": ["sum"], "nb_installations_pac": ["sum"], "pct_pac": ["mean"]}
    return E.round_doubles(A.flat_aggregate(B.facts(spark, sf), ["date_id"], plan), 6)


@query("a8_entity_totals", "SELECT dept, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}_sum" for c in S.COUNT_COLUMNS) + " FROM v_facts GROUP BY 1")
def a8(spark, sf):
    return A.flat_aggregate(B.facts(spark, sf), ["dept"], {c: ["sum"] for c in S.COUNT_COLUMNS})


@query(
    "a9_multi_function",
    f"SELECT dept, CAST(sum(nb_dpe_total) AS BIGINT) AS nb_dpe_total_sum, {he('avg(nb_dpe_total)', 6)} AS nb_dpe_total_mean, CAST(max(nb_installations_pac) AS BIGINT) AS nb_installations_pac_max, {he('stddev_samp(nb_installations_pac)', 6)} AS nb_installations_pac_std FROM v_facts GROUP BY 1",
)
def a9(spark, sf):
    plan = {"nb_dpe_total": ["sum", "mean"], "nb_installations_pac": ["max", "std"]}
    return E.round_doubles(A.flat_aggregate(B.facts(spark, sf), ["dept"], plan), 6)


@query("a10_mean_rate", f"SELECT dept, {he('avg(pct_pac)', 6)} AS pct_pac_mean FROM v_facts GROUP BY 1")
def a10(spark, sf):
    return E.round_doubles(A.flat_aggregate(B.facts(spark, sf), ["dept"], {"pct_pac": ["mean"]}), 6)


@query(
    "a11_region_totals",
    """WITH t AS (SELECT dept, sum(nb_installations_pac) AS p FROM v_facts GROUP BY dept)
SELECT region_code, count(*) AS departments, CAST(sum(p) AS BIGINT) AS nb_installations_pac FROM t JOIN v_geo g ON t.dept = g.dept GROUP BY 1""",
)
def a11(spark, sf):
    return A.region_totals(B.facts(spark, sf), geo_dimension(spark), ["nb_installations_pac"])


@query(
    "a12_seasonal_profile",
    f"SELECT dept, date_id % 100 AS month, {he('avg(nb_installations_pac)', 6)} AS nb_installations_pac_mean, {he('stddev_samp(nb_installations_pac)', 6)} AS nb_installations_pac_std, CAST(quantile_cont(nb_installations_pac, 0.5) AS DOUBLE) AS nb_installations_pac_median FROM v_facts GROUP BY 1, 2",
)
def a12(spark, sf):
    df = B.facts(spark, sf).withColumn("month", E.month_of("date_id"))
    out = A.flat_aggregate(df, ["dept", "month"], {"nb_installations_pac": ["mean", "std", "median"]})
    return E.round_doubles(out, 6)


AMPLITUDE = ["temp_mean", "nb_installations_pac", "precipitation_sum"]


@query(
    "a13_seasonal_amplitude",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH m AS (SELECT month, sum(CAST({c} AS DOUBLE)) AS s, count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS a FROM v_panel GROUP BY month)
SELECT '{c}' AS "column", {he('stddev_samp(a) / abs(sum(s) / sum(n))', 4)} AS seasonal_cv, first(month ORDER BY a DESC, month) AS peak_month,
 first(month ORDER BY a, month) AS trough_month FROM m HAVING sum(n) >= 100 AND abs(sum(s) / sum(n)) > 0.01)"""
        for c in AMPLITUDE
    ),
)
def a13(spark, sf):
    return A.seasonal_amplitude(B.panel(spark, sf), AMPLITUDE)


@query("a14_value_counts", "SELECT etiquette_dpe, count(*) AS count FROM v_cert GROUP BY 1")
def a14(spark, sf):
    return B.cert(spark, sf).groupBy("etiquette_dpe").count()


@query(
    "a15_distinct_counts",
    "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types, count(DISTINCT CAST(ts AS DATE)) AS days FROM events",
)
def a15(spark, sf):
    return B.table(spark, sf, "events").agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("event_type").alias("types"),
        F.countDistinct(F.col("ts").cast("date")).alias("days"),
    )


DESCRIBED = {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_linenumber": "int"}


@query(
    "a16_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {he(f'avg({c})', 4)} AS mean, {he(f'stddev_samp({c})', 4)} AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
 CAST(0 AS DOUBLE) AS pct_nan, {he(f'quantile_cont({c}, 0.25)', 4)} AS q25, {he(f'quantile_cont({c}, 0.5)', 4)} AS q50, {he(f'quantile_cont({c}, 0.75)', 4)} AS q75, '{t}' AS dtype FROM lineitem"""
        for c, t in DESCRIBED.items()
    ),
)
def a16(spark, sf):
    df = T.describe(B.table(spark, sf, "lineitem"), list(DESCRIBED))
    return df.withColumns({c: E.half_even(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "a17_overview",
    f"""SELECT count(*) AS n_rows, CAST(9 AS INTEGER) AS n_columns, CAST(0 AS DOUBLE) AS nan_pct, count(DISTINCT dept) AS n_departments, count(DISTINCT date_id) AS n_months,
  min(date_id) AS first_month, max(date_id) AS last_month, CAST(sum(nb_dpe_total) AS BIGINT) AS total_dpe, CAST(sum(nb_installations_pac) AS BIGINT) AS total_pac,
  {he('1e2 * sum(nb_installations_pac) / sum(nb_dpe_total)', 2)} AS pct_pac_global FROM v_facts""",
)
def a17(spark, sf):
    return A.overview(B.facts(spark, sf))


@query(
    "a18_histogram",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n FROM orders, b GROUP BY 1""",
)
def a18(spark, sf):
    return A.histogram(B.table(spark, sf, "orders"), "o_totalprice", 30)


@query(
    "a19_box_statistics",
    f"""SELECT c_mktsegment, count(*) AS n, {he('quantile_cont(o_totalprice, 0.25)', 6)} AS q25, {he('quantile_cont(o_totalprice, 0.5)', 6)} AS q50, {he('quantile_cont(o_totalprice, 0.75)', 6)} AS q75,
  {he('quantile_cont(o_totalprice, 0.25) - 1.5 * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25))', 6)} AS fence_low,
  {he('quantile_cont(o_totalprice, 0.75) + 1.5 * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25))', 6)} AS fence_high
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def a19(spark, sf):
    o, c = B.table(spark, sf, "orders"), B.table(spark, sf, "customer")
    df = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_totalprice")
    q = exact_quantiles(df, ["o_totalprice"], (0.25, 0.5, 0.75), ["c_mktsegment"])
    iqr = F.col("q75") - F.col("q25")
    out = q.withColumns({"fence_low": F.col("q25") - 1.5 * iqr, "fence_high": F.col("q75") + 1.5 * iqr})
    return E.round_doubles(out.drop("column"), 6)


@query(
    "a20_market_share",
    f"""WITH s AS (SELECT CAST(date_id // 100 AS INTEGER) AS year, dept_name, sum(nb_installations_pac) AS total_pac, sum(nb_dpe_total) AS total_dpe, sum(nb_installations_clim) AS total_clim
  FROM v_facts f JOIN v_geo g ON f.dept = g.dept GROUP BY 1, 2)
SELECT year, dept_name, CAST(total_pac AS BIGINT) AS total_pac, CAST(total_dpe AS BIGINT) AS total_dpe, {he('1e2 * total_pac / nullif(total_dpe, 0)', 2)} AS part_pac_pct,
  {he('1e2 * total_clim / nullif(total_dpe, 0)', 2)} AS part_clim_pct, {he('1e2 * total_pac / nullif(sum(total_pac) OVER (PARTITION BY year), 0)', 2)} AS part_pac_year_pct FROM s""",
)
def a20(spark, sf):
    geo = F.broadcast(geo_dimension(spark).select("dept", "dept_name"))
    df = B.facts(spark, sf).join(geo, "dept").withColumn("year", E.year_of("date_id"))
    return A.market_share(df)


@query(
    "a21_error_aggregates",
    f"""WITH p AS (SELECT dept, date_id, nb_installations_pac AS y, lag(nb_installations_pac) OVER (PARTITION BY dept ORDER BY date_id) AS p FROM v_facts)
SELECT dept, {he('avg(abs(y - p))', 6)} AS mae, {he('avg(y - p)', 6)} AS mean_bias, {he('stddev_samp(y - p)', 6)} AS residual_std, {he('avg(y)', 6)} AS actual_mean FROM p GROUP BY dept""",
)
def a21(spark, sf):
    df = B.facts(spark, sf).withColumn("p", F.lag("nb_installations_pac").over(W.by_entity()))
    return E.round_doubles(A.error_aggregates(df, ["dept"], "nb_installations_pac", "p"), 6)


@query(
    "a21_error_by_month",
    f"""WITH p AS (SELECT date_id, nb_installations_pac AS y, lag(nb_installations_pac) OVER (PARTITION BY dept ORDER BY date_id) AS p FROM v_facts)
SELECT date_id, {he('avg(abs(y - p))', 6)} AS mae, {he('avg(y - p)', 6)} AS mean_bias, {he('stddev_samp(y - p)', 6)} AS residual_std, {he('avg(y)', 6)} AS actual_mean FROM p GROUP BY date_id""",
)
def a21_month(spark, sf):
    df = B.facts(spark, sf).withColumn("p", F.lag("nb_installations_pac").over(W.by_entity()))
    return E.round_doubles(A.error_aggregates(df, ["date_id"], "nb_installations_pac", "p"), 6)


COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("a22_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def a22(spark, sf):
    return A.table_counts({t: B.table(spark, sf, t) for t in COUNTED})


@query("a23_source_summary", " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def a23(spark, sf):
    out = None
    for t in COUNTED:
        one = A.file_summary(B.table(spark, sf, t).select("_metadata")).select("file_name", "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "a24_trend_kpis",
    f"""WITH r AS (SELECT dept, nb_installations_pac AS v, row_number() OVER (PARTITION BY dept ORDER BY date_id DESC) AS r FROM v_facts)
SELECT dept, CAST(max(v) FILTER (WHERE r = 1) AS BIGINT) AS last_value, CAST(max(v) FILTER (WHERE r = 1) - coalesce(max(v) FILTER (WHERE r = 2), max(v) FILTER (WHERE r = 1)) AS BIGINT) AS delta,
  {he('CASE WHEN count(*) >= 12 THEN CASE WHEN avg(v) FILTER (WHERE r BETWEEN 7 AND 12) > 0 THEN (avg(v) FILTER (WHERE r <= 6) - avg(v) FILTER (WHERE r BETWEEN 7 AND 12)) / avg(v) FILTER (WHERE r BETWEEN 7 AND 12) * 100 ELSE 0 END END', 4)} AS trend_pct
FROM r WHERE r <= 12 GROUP BY dept""",
)
def a24(spark, sf):
    return A.trend_kpis(W.last_rows(B.facts(spark, sf), "dept", "date_id", 12), "nb_installations_pac")


@query(
    "a25_grid_aggregation",
    f"""SELECT p_size, {he('avg(p_retailprice)', 4)} AS rmse_mean, {he('stddev_samp(p_retailprice)', 4)} AS rmse_std FROM part GROUP BY 1""",
)
def a25(spark, sf):
    from retropanel.models.metrics import grid_summary

    grid = B.table(spark, sf, "part").select("p_size", F.col("p_retailprice").alias("rmse"))
    return E.round_doubles(grid_summary(grid, ["p_size"]), 4)


@query(
    "a26_completeness",
    f"""WITH l AS (SELECT date_id, dept, lag(nb_dpe_total, 1) OVER w AS l1, lag(nb_dpe_total, 6) OVER w AS l6 FROM v_facts WINDOW w AS (PARTITION BY dept ORDER BY date_id))
SELECT date_id, dept, CAST((l1 IS NOT NULL)::INT + (l6 IS NOT NULL)::INT AS INTEGER) AS n_valid_features, {he('((l1 IS NOT NULL)::INT + (l6 IS NOT NULL)::INT) * 1e2 / 2', 1)} AS pct_valid_features FROM l""",
)
def a26(spark, sf):
    w = W.by_entity()
    df = B.facts(spark, sf).select(
        "date_id", "dept", F.lag("nb_dpe_total", 1).over(w).alias("l1"), F.lag("nb_dpe_total", 6).over(w).alias("l6")
    )
    return A.completeness(df).drop("l1", "l6")


# --- windows -------------------------------------------------------------------------------

WIN = "WINDOW w AS (PARTITION BY dept ORDER BY date_id)"


def frame(k):
    return f"OVER (PARTITION BY dept ORDER BY date_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


@query(
    "w1_lag_features",
    "SELECT date_id, dept, " + ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}m" for c in S.LAG_COLUMNS for k in (1, 3, 6)) + f" FROM v_panel {WIN}",
)
def w1(spark, sf):
    df = B.panel(spark, sf)
    cols = W.lag_columns(E.present(df, S.LAG_COLUMNS), (1, 3, 6), W.by_entity())
    return df.select("date_id", "dept", *[c.alias(n) for n, c in cols.items()])


@query(
    "w2_rolling_mean",
    "SELECT date_id, dept, " + ", ".join(f"{he(f'avg({c}) {frame(k)}', 2)} AS {c}_rmean_{k}m" for c in S.COUNT_COLUMNS for k in (3, 6)) + " FROM v_facts",
)
def w2(spark, sf):
    cols = W.rolling_means(S.COUNT_COLUMNS, (3, 6), W.by_entity())
    return B.facts(spark, sf).select("date_id", "dept", *[c.alias(n) for n, c in cols.items()])


@query(
    "w3_rolling_std",
    "SELECT date_id, dept, " + ", ".join(f"{he(f'stddev_samp({c}) {frame(k)}', 2)} AS {c}_rstd_{k}m" for c in S.COUNT_COLUMNS for k in (3, 6)) + " FROM v_facts",
)
def w3(spark, sf):
    cols = W.rolling_stds(S.COUNT_COLUMNS, (3, 6), W.by_entity())
    return B.facts(spark, sf).select("date_id", "dept", *[c.alias(n) for n, c in cols.items()])


@query("w4_difference", "SELECT date_id, dept, " + ", ".join(f"{c} - lag({c}) OVER w AS {c}_diff_1m" for c in S.COUNT_COLUMNS) + f" FROM v_facts {WIN}")
def w4(spark, sf):
    cols = W.differences(S.COUNT_COLUMNS, W.by_entity())
    return B.facts(spark, sf).select("date_id", "dept", *[c.alias(n) for n, c in cols.items()])


@query(
    "w5_percent_change",
    "SELECT date_id, dept, " + ", ".join(f"{clip(he(change(c, f'lag({c}) OVER w'), 2), -200, 500)} AS {c}_pct_1m" for c in S.COUNT_COLUMNS) + f" FROM v_facts {WIN}",
)
def w5(spark, sf):
    cols = W.pct_changes(S.COUNT_COLUMNS, W.by_entity())
    return B.facts(spark, sf).select("date_id", "dept", *[c.alias(n) for n, c in cols.items()])


@query(
    "w6_group_deviation",
    f"SELECT date_id, dept, {he('hdd_sum - avg(hdd_sum) OVER (PARTITION BY dept, date_id % 100)', 2)} AS delta_hdd_vs_mean FROM v_wx_month",
)
def w6(spark, sf):
    df = PL.weather_features(B.wx(spark, sf)).withColumn("month", E.month_of("date_id"))
    return W.deviation_from_group(df, "hdd_sum", ["dept", "month"], "delta_hdd_vs_mean").select(
        "date_id", "dept", "delta_hdd_vs_mean"
    )


@query("w7_rank_in_period", "SELECT date_id, dept, nb_installations_pac, CAST(rank() OVER (PARTITION BY date_id ORDER BY nb_installations_pac DESC) AS INTEGER) AS rank FROM v_facts")
def w7(spark, sf):
    return W.rank_in_period(B.facts(spark, sf), "nb_installations_pac").select(
        "date_id", "dept", "nb_installations_pac", "rank"
    )


@query("w8_moving_average", f"SELECT date_id, dept, {he(f'avg(nb_installations_pac) {frame(3)}', 1)} AS moving_3m FROM v_facts")
def w8(spark, sf):
    mean = F.avg("nb_installations_pac").over(W.last_k(W.by_entity(), 3))
    return B.facts(spark, sf).select("date_id", "dept", E.half_even(mean, 1).alias("moving_3m"))


@query(
    "w9_year_over_year",
    f"""SELECT date_id, dept, nb_installations_pac, lag(nb_installations_pac, 12) OVER w AS previous_year,
  {he('(nb_installations_pac - lag(nb_installations_pac, 12) OVER w) / nullif(CAST(lag(nb_installations_pac, 12) OVER w AS DOUBLE), 0) * 100', 1)} AS yoy_pct FROM v_facts {WIN}""",
)
def w9(spark, sf):
    return W.year_over_year(B.facts(spark, sf), "nb_installations_pac", W.by_entity()).select(
        "date_id", "dept", "nb_installations_pac", "previous_year", "yoy_pct"
    )


@query(
    "w10_metric_ranks",
    f"""WITH s AS (SELECT p.dept, {he('avg(hdd_sum)', 4)} AS hdd, {he('avg(cdd_sum)', 4)} AS cdd, {he('avg(nb_installations_pac)', 4)} AS pac, {he('avg(nb_installations_clim)', 4)} AS clim
  FROM v_panel p WHERE nb_installations_pac IS NOT NULL AND hdd_sum IS NOT NULL GROUP BY 1),
r AS (SELECT *, CAST(rank() OVER (ORDER BY hdd DESC) AS INTEGER) AS rank_hdd, CAST(rank() OVER (ORDER BY cdd DESC) AS INTEGER) AS rank_cdd,
  CAST(rank() OVER (ORDER BY pac DESC) AS INTEGER) AS rank_pac, CAST(rank() OVER (ORDER BY clim DESC) AS INTEGER) AS rank_clim FROM s)
SELECT *, abs(rank_hdd - rank_pac) AS gap_hdd_pac, abs(rank_cdd - rank_clim) AS gap_cdd_clim FROM r""",
)
def w10(spark, sf):
    df = B.panel(spark, sf).filter("nb_installations_pac IS NOT NULL AND hdd_sum IS NOT NULL")
    means = {"hdd": "hdd_sum", "cdd": "cdd_sum", "pac": "nb_installations_pac", "clim": "nb_installations_clim"}
    stats = df.groupBy("dept").agg(*[E.half_even(F.avg(c), 4).alias(n) for n, c in means.items()])
    ranked = W.metric_ranks(stats, "dept", list(means))
    gap = lambda a, b: F.abs(F.col(f"rank_{a}") - F.col(f"rank_{b}"))
    return ranked.withColumns({"gap_hdd_pac": gap("hdd", "pac"), "gap_cdd_clim": gap("cdd", "clim")})


@query(
    "w11_temporal_anomalies",
    f"""WITH c AS (SELECT dept, date_id, CAST(nb_installations_pac AS DOUBLE) AS value, {change('nb_installations_pac', 'lag(nb_installations_pac) OVER w')} AS ch FROM v_facts {WIN})
SELECT dept, date_id, value, {he('ch', 1)} AS pct_change, CASE WHEN ch > 0 THEN 'spike' ELSE 'drop' END AS type FROM c WHERE abs(ch) > 50""",
)
def w11(spark, sf):
    return W.temporal_anomalies(B.facts(spark, sf), "nb_installations_pac")


@query(
    "w12_max_normalised",
    f"SELECT date_id, dept, {he('hdd_sum / greatest((SELECT max(hdd_sum) FROM v_wx_month), 1)', 4)} AS hdd_norm FROM v_wx_month",
)
def w12(spark, sf):
    df = PL.weather_features(B.wx(spark, sf))
    top = W.global_scalars(df, {"hdd_sum": F.max("hdd_sum")})
    return df.select(
        "date_id", "dept", E.half_even(F.col("hdd_sum") / F.greatest(top["hdd_sum"], F.lit(1.0)), 4).alias("hdd_norm")
    )


@query("w13_trend_index", "SELECT date_id, dept, CAST(date_id // 100 - (SELECT min(date_id // 100) FROM v_facts) AS INTEGER) AS year_trend FROM v_facts")
def w13(spark, sf):
    df = B.facts(spark, sf).withColumn("year", E.year_of("date_id"))
    return P.trends(df, P.scaling_maxima(df)).select("date_id", "dept", "year_trend")


@query(
    "w14_cumulative_share",
    f"""WITH i AS (SELECT p_type, p_brand AS feature, CAST(count(*) AS DOUBLE) AS importance FROM part GROUP BY 1, 2),
c AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY importance DESC, feature) AS rank, sum(importance) OVER (PARTITION BY p_type ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) * 1e2 / sum(importance) OVER (PARTITION BY p_type) AS cum FROM i)
SELECT p_type, feature, importance, CAST(rank AS INTEGER) AS rank, {he('cum', 6)} AS cum_pct, CAST(min(rank) FILTER (WHERE cum >= 50) OVER (PARTITION BY p_type) AS INTEGER) AS rank_at_50,
 CAST(min(rank) FILTER (WHERE cum >= 80) OVER (PARTITION BY p_type) AS INTEGER) AS rank_at_80 FROM c""",
)
def w14(spark, sf):
    table = B.table(spark, sf, "part").groupBy("p_type", F.col("p_brand").alias("feature")).agg(
        F.count(F.lit(1)).cast("double").alias("importance")
    )
    shares = W.cumulative_share(table, "importance", "p_type", "feature")
    marks = W.first_reaching(shares, "p_type", (50, 80))
    return shares.join(marks, "p_type").withColumn("cum_pct", E.half_even("cum_pct", 6))


@query(
    "w15_display_rank",
    """SELECT g.region_code, f.dept, CAST(sum(nb_dpe_total) AS BIGINT) AS total, CAST(row_number() OVER (PARTITION BY g.region_code ORDER BY sum(nb_dpe_total) DESC, f.dept) AS INTEGER) AS rank
FROM v_facts f JOIN v_geo g ON f.dept = g.dept GROUP BY 1, 2""",
)
def w15(spark, sf):
    totals = B.facts(spark, sf).groupBy("dept").agg(F.sum("nb_dpe_total").alias("total"))
    geo = F.broadcast(geo_dimension(spark).select("dept", "region_code"))
    return W.display_rank(totals.join(geo, "dept"), "total", "region_code", "dept")


@query(
    "w16_lookback_sequences",
    f"""WITH s AS (SELECT date_id, dept, CAST(nb_installations_pac AS DOUBLE) AS label, row_number() OVER w AS r,
  CAST(lag(nb_dpe_total, 3) OVER w AS DOUBLE) AS x3, CAST(lag(nb_dpe_total, 2) OVER w AS DOUBLE) AS x2, CAST(lag(nb_dpe_total, 1) OVER w AS DOUBLE) AS x1 FROM v_facts {WIN})
SELECT date_id, dept, label, x3, x2, x1 FROM s WHERE r > 3""",
)
def w16(spark, sf):
    seq = W.lookback_sequences(
        B.facts(spark, sf), ["nb_dpe_total", "nb_installations_clim"], "nb_installations_pac", 3, W.by_entity()
    )
    part = lambda i: F.col("sequence")[i][0]
    return seq.select("date_id", "dept", "label", part(0).alias("x3"), part(1).alias("x2"), part(2).alias("x1"))


@query(
    "w17_month_gaps",
    f"""WITH d AS (SELECT DISTINCT c_custkey, {date_id('o_orderdate')} AS date_id FROM orders JOIN customer ON o_custkey = c_custkey),
l AS (SELECT c_custkey, date_id, lead(date_id) OVER (PARTITION BY c_custkey ORDER BY date_id) AS nx FROM d)
SELECT c_custkey, date_id AS gap_after, nx AS gap_before FROM l WHERE nx <> {next_id('date_id')}""",
)
def w17(spark, sf):
    o = B.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), E.date_id("o_orderdate").alias("date_id")
    )
    return W.month_gaps(o.distinct(), ["c_custkey"])


@query(
    "w18_last_rows",
    """SELECT dept, date_id, nb_dpe_total, CAST(r AS INTEGER) AS recency FROM (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY date_id DESC) AS r FROM v_facts) WHERE r <= 12""",
)
def w18(spark, sf):
    return W.last_rows(B.facts(spark, sf), "dept", "date_id", 12).select("dept", "date_id", "nb_dpe_total", "recency")


@query(
    "w0_dense_calendar",
    f"""WITH m AS (SELECT DISTINCT date_id FROM v_facts), e AS (SELECT DISTINCT dept FROM v_facts),
g AS (SELECT e.dept, m.date_id FROM e CROSS JOIN m)
SELECT g.dept, g.date_id, f.nb_dpe_total, lag(f.nb_dpe_total, 3) OVER (PARTITION BY g.dept ORDER BY g.date_id) AS nb_dpe_total_lag_3m
FROM g LEFT JOIN v_facts f ON g.dept = f.dept AND g.date_id = f.date_id""",
)
def w0(spark, sf):
    df = B.facts(spark, sf).select("dept", "date_id", "nb_dpe_total")
    dense = G.dense_calendar(df, df)
    return dense.withColumns(W.lag_columns(["nb_dpe_total"], [3], W.by_entity()))


@query(
    "w0_feature_panel",
    None,
)
def feature_panel(spark, sf):
    return P.engineer(materialize(B.panel(spark, sf)))
