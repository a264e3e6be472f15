"""Outliers, correlations and their reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.operators import iforest
from retropanel.operators import outliers as O
from retropanel.operators import stats as T
from retropanel.operators import windows as W
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import he
from retropanel.session import materialize

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPREAD = ["value", "user_id"]


def fences(c: str, table: str, factor: str = "1.5") -> str:
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS n, quantile_cont({c}, 0.25) - {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower, "
        f"quantile_cont({c}, 0.75) + {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper FROM {table}"
    )


@query(
    "o1_iqr_report",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH b AS ({fences(c, 'events', '0.5')})
SELECT b."column", count(*) AS n_outliers, {he('1e2 * count(*) / max(b.n)', 2)} AS pct, {he('max(b.lower)', 4)} AS lower_bound, {he('max(b.upper)', 4)} AS upper_bound
FROM events, b WHERE {c} < b.lower OR {c} > b.upper GROUP BY 1)"""
        for c in SPREAD
    ),
)
def o1(spark, sf):
    return O.iqr_report(B.table(spark, sf, "events"), SPREAD, 0.5)


MED = "(SELECT quantile_cont({c}, 0.5) FROM events)"


@query(
    "o2_modified_zscore",
    f"""WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events), d AS (SELECT value, med, abs(value - med) AS a FROM events, m),
s AS (SELECT quantile_cont(a, 0.5) AS mad FROM d)
SELECT 'value' AS "column", count(*) FILTER (WHERE abs(0.6745 * (value - med) / mad) > 3.5) AS n_outliers,
  {he('1e2 * count(*) FILTER (WHERE abs(0.6745 * (value - med) / mad) > 3.5) / count(*)', 2)} AS pct, {he('max(med)', 6)} AS median, {he('max(mad)', 6)} AS mad FROM d, s""",
)
def o2(spark, sf):
    out = O.zscore_report(B.table(spark, sf, "events"), ["value"])
    return out.withColumns({c: E.half_even(c, 6) for c in ("median", "mad")})


@query("o3_isolation_forest")
def o3(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "value", F.hour("ts").alias("hour"))
    scored = materialize(iforest.score(events, ["value", "hour"], ["event_id"]))
    return scored.withColumn("is_outlier", iforest.flag_isolated(scored))


@query(
    "o4_flags_and_votes",
    f"""WITH m AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, quantile_cont(value, 0.5) AS med FROM events),
s AS (SELECT quantile_cont(abs(value - med), 0.5) AS mad FROM events, m),
f AS (SELECT event_id, (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS i, abs(0.6745 * (value - med) / mad) > 3.5 AS z FROM events, m, s)
SELECT event_id, i AS _outlier_iqr, z AS _outlier_zscore, CAST(i AS INTEGER) + CAST(z AS INTEGER) AS _outlier_score, CAST(i AS INTEGER) + CAST(z AS INTEGER) >= 2 AS _outlier_consensus FROM f""",
)
def o4(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "value")
    return O.vote(O.flag_univariate(events, ["value"]), ["_outlier_iqr", "_outlier_zscore"]).drop("value")


@query("o4_three_method_votes")
def o4_all(spark, sf):
    stored = B.stored_panel(spark, sf)
    columns = ["nb_dpe_total", "nb_installations_pac", "temp_mean", "hdd_sum", "cdd_sum", "confiance_menages"]
    flagged = O.detect_and_flag(stored, ["date_id", "dept"], columns)
    return flagged.select("date_id", "dept", *[c for c in flagged.columns if c.startswith("_outlier")])


@query(
    "o5_winsorise",
    f"""WITH b AS ({fences('value', 'events')})
SELECT event_id, {he('CASE WHEN value < lower THEN lower WHEN value > upper THEN upper ELSE value END', 6)} AS value FROM events, b""",
)
def o5(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "value")
    return O.winsorize(events, ["value"]).withColumn("value", E.half_even("value", 6))


@query(
    "o6_remove_flagged",
    f"""WITH b AS ({fences('value', 'events')}) SELECT event_id, value FROM events, b WHERE NOT (value < lower OR value > upper)""",
)
def o6(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "value")
    return O.remove_outliers(O.flag_univariate(events, ["value"]), use_consensus=False).select("event_id", "value")


@query(
    "o7_strategy_report",
    f"""WITH b AS ({fences('value', 'events')})
SELECT 'flag' AS strategy, count(*) AS n_rows, {he('max(value)', 6)} AS top FROM events
UNION ALL SELECT 'clip', count(*), {he('max(CASE WHEN value > upper THEN upper ELSE value END)', 6)} FROM events, b
UNION ALL SELECT 'remove', count(*), {he('max(value)', 6)} FROM events, b WHERE NOT (value < lower OR value > upper)""",
)
def o7(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "value")
    flagged = materialize(O.flag_univariate(events, ["value"]))
    out = None
    for s in ("flag", "clip", "remove"):
        one = O.treat(flagged, s, ["value"], use_consensus=False).agg(
            F.count(F.lit(1)).alias("n_rows"), E.half_even(F.max("value"), 6).alias("top")
        )
        one = one.select(F.lit(s).alias("strategy"), "n_rows", "top")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "o8_numeric_columns",
    " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n FROM v_panel" for c in ("nb_dpe_total", "nb_installations_pac", "nb_installations_clim", "nb_dpe_classe_ab", "pct_pac", "pct_clim", "pct_classe_ab")),
)
def o8(spark, sf):
    df = B.facts(spark, sf)
    names = O.analysed_columns(df)
    return T._rows(df, [], {c: F.count(c) for c in names}, "n")


# --- correlations --------------------------------------------------------------------------


@query(
    "c1_correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {he(f'corr({a}, {b})', 6)} AS r FROM lineitem" for a, b in combinations(LINE, 2)),
)
def c1(spark, sf):
    return E.round_doubles(T.correlation_pairs(B.table(spark, sf, "lineitem"), LINE), 6)


# forty columns of line items, some with gaps
WIDE = {f"x{k:02d}": f"CASE WHEN l_linenumber % {k + 2} <> 0 THEN (l_partkey * {k} + l_suppkey) % {97 + k} + l_quantity END" for k in range(1, 41)}


@query(
    "c1_wide_correlation",
    f"WITH w AS (SELECT {', '.join(f'CAST({v} AS DOUBLE) AS {c}' for c, v in WIDE.items())} FROM lineitem), c AS (SELECT {', '.join(f'corr({a}, {b}) AS {a}_{b}' for a, b in combinations(WIDE, 2))} FROM w) "
    + f"SELECT a, b, {he('r', 6)} AS r FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {a}_{b} AS r FROM c" for a, b in combinations(WIDE, 2)) + ")",
)
def c1_wide(spark, sf):
    wide = B.table(spark, sf, "lineitem").select(*[F.expr(v).cast("double").alias(c) for c, v in WIDE.items()])
    return E.round_doubles(T.correlation_pairs(wide, list(WIDE)), 6)


WITH_TARGET = ["nb_dpe_total", "nb_installations_clim", "temp_mean", "hdd_sum", "confiance_menages", "nb_logements_autorises", "altitude_mean"]


@query(
    "c2_target_correlations",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {he(f'corr({c}, nb_installations_pac)', 5)} AS r FROM v_panel" for c in WITH_TARGET),
)
def c2(spark, sf):
    return E.round_doubles(T.target_correlations(B.panel(spark, sf), WITH_TARGET, "nb_installations_pac"), 5)


@query(
    "c3_group_correlations",
    " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS feature, {he(f'corr({c}, l_extendedprice)', 6)} AS r FROM lineitem GROUP BY 1 HAVING count(*) > 5" for c in ("l_quantity", "l_tax")),
)
def c3(spark, sf):
    df = B.table(spark, sf, "lineitem")
    return E.round_doubles(
        T.target_correlations(df, ["l_quantity", "l_tax"], "l_extendedprice", ["l_returnflag"], 5), 6
    )


@query(
    "c4_collinear_advice",
    f"""WITH p AS (SELECT corr(nb_dpe_total, nb_installations_pac) AS dp, corr(nb_dpe_total, nb_installations_clim) AS dc, corr(nb_installations_pac, nb_installations_clim) AS pc FROM v_facts),
r AS (SELECT 'nb_dpe_total' AS a, 'nb_installations_pac' AS b, dp AS r FROM p UNION ALL SELECT 'nb_dpe_total', 'nb_installations_clim', dc FROM p UNION ALL SELECT 'nb_installations_pac', 'nb_installations_clim', pc FROM p)
SELECT a, b, {he('r', 5)} AS r FROM r WHERE abs(r) > 0.3""",
)
def c4(spark, sf):
    names = ["nb_dpe_total", "nb_installations_pac", "nb_installations_clim"]
    pairs = T.correlation_pairs(B.facts(spark, sf), names)
    return E.round_doubles(T.collinear_pairs(pairs, 0.3), 5)


@query("c4_keep_drop")
def c4_advice(spark, sf):
    names = ["nb_dpe_total", "nb_installations_pac", "nb_installations_clim"]
    return T.keep_drop_advice(T.collinear_pairs(T.correlation_pairs(B.facts(spark, sf), names), 0.3))


LAGGED = ["nb_dpe_total", "nb_installations_pac"]


@query(
    "c5_lag_correlations",
    "WITH l AS (SELECT *, " + ", ".join(f"lag({c}, {k}) OVER w AS {c}_{k}" for c in LAGGED for k in (1, 3, 6))
    + " FROM v_facts WINDOW w AS (PARTITION BY dept ORDER BY date_id)) "
    + " UNION ALL ".join("SELECT '" + c + "' AS variable, " + ", ".join(f"{he(f'corr({c}_{k}, nb_installations_pac)', 5)} AS lag_{k}m" for k in (1, 3, 6)) + " FROM l" for c in LAGGED),
)
def c5(spark, sf):
    df = B.facts(spark, sf).withColumns(W.lag_columns(LAGGED, (1, 3, 6), W.by_entity()))
    return E.round_doubles(T.lag_correlations(df, LAGGED, (1, 3, 6), "nb_installations_pac"), 5)


def rank_sql(c: str, target: str, table: str) -> str:
    avg_rank = lambda x: f"(rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0)"
    return f"""SELECT '{c}' AS "column", count(*) AS n, {he('corr(rx, ry)', 6)} AS rho FROM (SELECT {avg_rank(c)} AS rx, {avg_rank(target)} AS ry FROM {table} WHERE {c} IS NOT NULL AND {target} IS NOT NULL)"""


@query("c6_spearman", " UNION ALL ".join(rank_sql(c, "l_extendedprice", "lineitem") for c in ("l_quantity", "l_discount", "l_linenumber")))
def c6(spark, sf):
    df = B.table(spark, sf, "lineitem")
    return E.round_doubles(T.spearman(df, ["l_quantity", "l_discount", "l_linenumber"], "l_extendedprice"), 6)


@query(
    "c7_linear_fits",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n, {he(f'regr_slope(l_extendedprice, {c})', 4)} AS slope, {he(f'regr_intercept(l_extendedprice, {c})', 4)} AS intercept, {he(f'corr({c}, l_extendedprice)', 4)} AS r FROM lineitem" for c in ("l_quantity", "l_tax")),
)
def c7(spark, sf):
    df = B.table(spark, sf, "lineitem")
    return E.round_doubles(T.linear_fits(df, ["l_quantity", "l_tax"], "l_extendedprice"), 4)


@query(
    "c8_feature_screen",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {he(f'1e2 * count(*) FILTER (WHERE {c} IS NULL) / count(*)', 4)} AS null_pct, {he(f'corr({c}, precipitation_sum)', 4)} AS r, {he(f'avg({c})', 4)} AS mean,
 {he(f'stddev_samp({c})', 4)} AS std, {he(f'min({c})', 4)} AS min, {he(f'max({c})', 4)} AS max FROM v_wx_raw"""
        for c in ("temperature_2m_mean", "wind_speed_10m_max")
    ),
)
def c8(spark, sf):
    df = B.wx_raw(spark, sf)
    return E.round_doubles(T.feature_screen(df, ["temperature_2m_mean", "wind_speed_10m_max"], "precipitation_sum"), 4)


@query(
    "t4_top_correlations",
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {he(f'corr({c}, nb_installations_pac)', 5)} AS r FROM v_panel" for c in WITH_TARGET) + ") ORDER BY abs(r) DESC LIMIT 3",
)
def t4(spark, sf):
    corr = T.target_correlations(B.panel(spark, sf), WITH_TARGET, "nb_installations_pac")
    return E.round_doubles(T.strongest(corr, 3), 5)
