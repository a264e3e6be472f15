"""Splits, regressors, evaluation and forecasts on the feature panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.models import forecast as FC
from retropanel.models import metrics as M
from retropanel.models import prepare as PR
from retropanel.models import ridge as RI
from retropanel.models import search as SE
from retropanel.models import train as TR
from retropanel.operators import aggregates as A
from retropanel.operators import windows as W
from retropanel.queries import bindings as B
from retropanel.queries.registry import query
from retropanel.queries.sqlviews import TRAIN_END, VAL_END, he, next_id
from retropanel.session import materialize

TARGET = "nb_installations_pac"
HORIZON = 6


def features(spark, sf):
    return B.stored_features(spark, sf)


def prepared(spark, sf, without_target_lags=False):
    return PR.prepare(features(spark, sf), TARGET, TRAIN_END, VAL_END, without_target_lags)


SPLIT = f"CASE WHEN date_id <= {TRAIN_END} THEN 'train' WHEN date_id <= {VAL_END} THEN 'val' ELSE 'test' END"


@query("m1_temporal_split", f"SELECT date_id, dept, {SPLIT} AS split FROM v_facts")
def m1(spark, sf):
    return PR.temporal_split(B.facts(spark, sf), TRAIN_END, VAL_END).select("date_id", "dept", "split")


@query("m2_feature_selection")
def m2(spark, sf):
    df = features(spark, sf)
    rows = [(n, "all") for n in PR.select_features(df, TARGET)]
    rows += [(n, "exogenous") for n in PR.select_features(df, TARGET, without_target_lags=True)]
    return spark.createDataFrame(rows, "feature string, selection string")


@query("m3_non_empty_columns", "SELECT 'surface' AS feature, count(surface_habitable_logement) AS n FROM v_cert_raw")
def m3(spark, sf):
    df = B.cert_raw(spark, sf).select(
        F.col("surface_habitable_logement").alias("surface"), F.lit(None).cast("double").alias("nothing")
    )
    kept = PR.non_empty(df, ["surface", "nothing"])
    return df.agg(F.count(kept[0]).alias("n")).select(F.lit(kept[0]).alias("feature"), "n")


@query(
    "m4_median_imputation",
    f"""WITH t AS (SELECT quantile_cont(temperature_2m_mean, 0.5) AS m FROM v_wx WHERE date_id <= {TRAIN_END})
SELECT time, dept, coalesce(CASE WHEN day(time) = 1 THEN NULL ELSE temperature_2m_mean END, (SELECT quantile_cont(CASE WHEN day(time) = 1 THEN NULL ELSE temperature_2m_mean END, 0.5) FROM v_wx WHERE date_id <= {TRAIN_END})) AS t FROM v_wx""",
)
def m4(spark, sf):
    df = B.wx(spark, sf).select(
        "time", "dept", "date_id", F.when(F.day("time") != 1, F.col("temperature_2m_mean")).alias("t")
    )
    medians = PR.train_medians(df.filter(F.col("date_id") <= TRAIN_END), ["t"])
    return PR.impute(df, medians).drop("date_id")


@query("m5_robust_scaling")
def m5(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = prepared(spark, sf).rows
    return rows.select("date_id", "dept", "split", vector_to_array("features").alias("scaled"))


@query("m6_ridge")
def m6(spark, sf):
    prep = prepared(spark, sf)
    return TR.predictions(TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0), prep.rows, "ridge")


METRICS = ", ".join(
    f"{he(x, 5)} AS {n}"
    for n, x in {
        "rmse": "sqrt(avg((label - prediction) ** 2))",
        "mae": "avg(abs(label - prediction))",
        "mape": "1e2 * avg(abs((label - prediction) / nullif(label, 0)))",
        "r2": "1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*))",
    }.items()
)

ALPHA = 10.0


@query(
    "m6_ridge_one_feature",
    f"""WITH r AS (SELECT date_id, dept, {SPLIT} AS split, CAST(nb_dpe_total AS DOUBLE) AS x, CAST(nb_installations_pac AS DOUBLE) AS y FROM v_facts),
t AS (SELECT avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS slope FROM r WHERE split = 'train')
SELECT date_id, dept, split, y AS label, {he('greatest(my + slope * (x - mx), 0)', 6)} AS prediction FROM r, t""",
)
def m6_one(spark, sf):
    return E.round_doubles(ridge_on_one(spark, sf), 6)


def ridge_on_one(spark, sf):
    """The regressor on one input, whose solution is a formula."""
    from pyspark.ml.feature import VectorAssembler

    rows = PR.temporal_split(B.facts(spark, sf), TRAIN_END, VAL_END).withColumn("label", F.col(TARGET).cast("double"))
    rows = VectorAssembler(inputCols=["nb_dpe_total"], outputCol="features").transform(rows)
    model = TR.fit_ridge(rows.filter("split = 'train'"), ALPHA)
    return TR.predictions(model, rows, "ridge").drop("model")


@query(
    "m18_overfitting_one_feature",
    f"""WITH r AS (SELECT {SPLIT} AS split, CAST(nb_dpe_total AS DOUBLE) AS x, CAST(nb_installations_pac AS DOUBLE) AS y FROM v_facts),
t AS (SELECT avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS slope FROM r WHERE split = 'train'),
p AS (SELECT split, y AS label, greatest(my + slope * (x - mx), 0) AS prediction FROM r, t)
SELECT split, count(*) AS n, {METRICS} FROM p GROUP BY split""",
)
def m18_one(spark, sf):
    return E.round_doubles(M.compute_metrics(ridge_on_one(spark, sf), "label", "prediction", ["split"]), 5)


@query("m7_ridge_alpha_scores")
def m7(spark, sf):
    return TR.ridge_alpha_scores(prepared(spark, sf))


ALPHAS = (0.1, 100.0, 100000.0)


@query(
    "m7_two_feature_alphas",
    f"""WITH r AS (SELECT date_id, CAST(nb_dpe_total AS DOUBLE) AS x, CAST(nb_installations_clim AS DOUBLE) AS z, CAST(nb_installations_pac AS DOUBLE) AS y FROM v_facts WHERE date_id <= {TRAIN_END}),
m AS (SELECT date_id, count(*) AS c FROM r GROUP BY 1),
b AS (SELECT date_id, least(floor(coalesce(sum(c) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 4 / (SELECT sum(c) FROM m)), 3) AS block FROM m),
f AS (SELECT r.*, block FROM r JOIN b ON r.date_id = b.date_id), k AS (SELECT unnest([1, 2, 3]) AS k), a AS (SELECT unnest([{', '.join(map(str, ALPHAS))}]::DOUBLE[]) AS alpha),
t AS (SELECT k, alpha, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) * count(*) + alpha AS xx, var_pop(z) * count(*) + alpha AS zz, covar_pop(x, z) * count(*) AS xz,
  covar_pop(x, y) * count(*) AS xy, covar_pop(z, y) * count(*) AS zy FROM f JOIN k ON block < k, a GROUP BY k, alpha),
s AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM t),
e AS (SELECT alpha, k, sqrt(avg((y - my - bx * (x - mx) - bz * (z - mz)) ** 2)) AS rmse FROM s JOIN f ON block = k GROUP BY alpha, k)
SELECT alpha, {he('avg(rmse)', 6)} AS rmse FROM e GROUP BY alpha""",
)
def m7_two(spark, sf):
    """The penalties' scores on two inputs, whose solutions are formulas."""
    from pyspark.ml.feature import VectorAssembler

    train = B.facts(spark, sf).filter(F.col("date_id") <= TRAIN_END).withColumn("label", F.col(TARGET).cast("double"))
    rows = VectorAssembler(inputCols=["nb_dpe_total", "nb_installations_clim"], outputCol="features").transform(train)
    folded = PR.expanding_folds(rows).select("block", "label", "features")
    return E.round_doubles(spark.createDataFrame(RI.alpha_errors(folded, ALPHAS), "alpha double, rmse double"), 6)


FOLDS = f"""r AS (SELECT date_id, CAST(nb_dpe_total AS DOUBLE) AS x, CAST(nb_installations_pac AS DOUBLE) AS y FROM v_facts WHERE date_id <= {TRAIN_END}),
m AS (SELECT date_id, count(*) AS c FROM r GROUP BY 1),
b AS (SELECT date_id, least(floor(coalesce(sum(c) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 4 / (SELECT sum(c) FROM m)), 3) AS block FROM m),
f AS (SELECT r.*, block FROM r JOIN b ON r.date_id = b.date_id), k AS (SELECT unnest([1, 2, 3]) AS k)"""


@query(
    "m11_one_feature_folds",
    f"""WITH {FOLDS}, t AS (SELECT k, avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS slope FROM f JOIN k ON block < k GROUP BY k),
p AS (SELECT k, y AS label, my + slope * (x - mx) AS prediction FROM t JOIN f ON block = k), e AS (SELECT k, {METRICS} FROM p GROUP BY k)
SELECT {', '.join(f"{he(f'avg({m})', 4)} AS {m}_mean, {he(f'stddev_pop({m})', 4)} AS {m}_std" for m in ('rmse', 'mae', 'mape', 'r2'))} FROM e""",
)
def m11_one(spark, sf):
    """All metrics of the folds on one input."""
    from pyspark.ml.feature import VectorAssembler

    train = B.facts(spark, sf).filter(F.col("date_id") <= TRAIN_END).withColumn("label", F.col(TARGET).cast("double"))
    rows = VectorAssembler(inputCols=["nb_dpe_total"], outputCol="features").transform(train)
    folded = materialize(PR.expanding_folds(rows).select("block", "label", "features"))
    return E.round_doubles(TR.cv_summary(E.round_doubles(RI.fold_metrics(folded, ALPHA), 5)), 4)


PAIR = ("nb_dpe_total", "nb_installations_clim")


@query(
    "m5_scaled_columns",
    f"""WITH r AS (SELECT date_id, dept, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in PAIR)} FROM v_facts),
q AS (SELECT {', '.join(f'quantile_cont({c}, {p}) AS {c}_{n}' for c in PAIR for p, n in ((0.25, 'a'), (0.5, 'm'), (0.75, 'z')))} FROM r WHERE date_id <= {TRAIN_END})
SELECT date_id, dept, {', '.join(he(f'({c} - {c}_m) / nullif({c}_z - {c}_a, 0)', 6) + f' AS {c}' for c in PAIR)} FROM r, q""",
)
def m5_columns(spark, sf):
    """Median and quartile range of the training months, applied to all."""
    df = B.facts(spark, sf)
    scale = PR.RobustScale.fit(df.filter(F.col("date_id") <= TRAIN_END), PAIR)
    named = [c.alias(n) for n, c in zip(PAIR, scale.columns(PAIR).values())]
    return E.round_doubles(df.select("date_id", "dept", *named), 6)


def one_input(spark, sf):
    """The regressor on one input, and what it was fitted on."""
    from pyspark.ml.feature import VectorAssembler

    rows = PR.temporal_split(B.facts(spark, sf), TRAIN_END, VAL_END).withColumn("label", F.col(TARGET).cast("double"))
    rows = VectorAssembler(inputCols=["nb_dpe_total"], outputCol="features").transform(rows)
    prep = PR.Prepared(rows, ["nb_dpe_total"], {}, PR.RobustScale((0.0,), (1.0,)))
    return prep, TR.fit_ridge(rows.filter("split = 'train'"), ALPHA)


SLOPE = f"SELECT regr_sxy(y, x) / (regr_sxx(y, x) + {ALPHA}) AS slope FROM (SELECT date_id, CAST(nb_dpe_total AS DOUBLE) AS x, CAST(nb_installations_pac AS DOUBLE) AS y FROM v_facts) WHERE date_id <= {TRAIN_END}"


@query("m15_one_feature", f"SELECT 'nb_dpe_total' AS feature, {he('abs(slope)', 6)} AS importance FROM ({SLOPE})")
def m15_one(spark, sf):
    return E.round_doubles(TR.importance(*one_input(spark, sf)), 6)


@query(
    "m16_one_feature",
    f"WITH s AS ({SLOPE}), m AS (SELECT avg(CAST(nb_dpe_total AS DOUBLE)) AS m FROM v_facts) SELECT 'nb_dpe_total' AS feature, {he('avg(abs(slope * (nb_dpe_total - m)))', 6)} AS attribution FROM v_facts, s, m",
)
def m16_one(spark, sf):
    return E.round_doubles(TR.linear_attribution(*one_input(spark, sf)), 6)


@query("m8_gradient_boosting")
def m8(spark, sf):
    prep = prepared(spark, sf)
    return TR.predictions(TR.fit_boosting(prep.rows), prep.rows, "boosting")


@query("m9_seasonal_models")
def m9(spark, sf):
    split = PR.temporal_split(B.panel(spark, sf), TRAIN_END, VAL_END)
    return TR.fit_seasonal(split, TARGET)


@query("m10_exogenous_ridge")
def m10(spark, sf):
    prep = prepared(spark, sf, without_target_lags=True)
    return TR.predictions(TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0), prep.rows, "ridge_exogenous")


def folded_rows(prep, *columns):
    return PR.expanding_folds(prep.rows.filter("split = 'train'")).select("block", "label", *columns)


@query("m11_cross_validation")
def m11(spark, sf):
    prep = prepared(spark, sf)
    return TR.cv_summary(RI.fold_metrics(materialize(folded_rows(prep, "features")), 1.0))


# trees of the last rung; the search's default of 200 takes over five minutes (see README)
ROUNDS = 20
SETTING = {"maxDepth": "max_depth", "minInstancesPerNode": "min_leaf", "stepSize": "step_size"}


@query("m12_parameter_grid")
def m12(spark, sf):
    """The whole grid of 36 settings in three folds, up to ``ROUNDS`` trees each."""
    return SE.outcome_frame(spark, TR.boosting_search(prepared(spark, sf), rounds=ROUNDS, least=5), SETTING)


NAIVE = f"SELECT dept, date_id, {SPLIT} AS split, CAST(nb_installations_pac AS DOUBLE) AS label, CAST(lag(nb_installations_pac) OVER (PARTITION BY dept ORDER BY date_id) AS DOUBLE) AS prediction FROM v_facts"
def naive(spark, sf):
    """Last month's count as the prediction."""
    df = PR.temporal_split(B.facts(spark, sf), TRAIN_END, VAL_END)
    return df.select(
        "dept",
        "date_id",
        "split",
        F.col(TARGET).cast("double").alias("label"),
        F.lag(TARGET).over(W.by_entity()).cast("double").alias("prediction"),
        F.lit("naive").alias("model"),
    )


@query("m13_metrics", f"WITH p AS ({NAIVE}) SELECT split, count(*) AS n, {METRICS} FROM p WHERE prediction IS NOT NULL GROUP BY split")
def m13(spark, sf):
    return E.round_doubles(M.compute_metrics(naive(spark, sf), "label", "prediction", ["split"]), 5)


def side(model: str, source: str) -> str:
    cells = ", ".join(
        f"max({m}) FILTER (WHERE split = '{s}') AS {s}_{m}" for s in ("train", "val", "test") for m in ("rmse", "mae", "mape", "r2")
    )
    return f"SELECT '{model}' AS model, {cells} FROM (SELECT split, {METRICS} FROM ({source}) WHERE prediction IS NOT NULL GROUP BY split)"


MEAN3 = f"SELECT dept, date_id, {SPLIT} AS split, CAST(nb_installations_pac AS DOUBLE) AS label, avg(nb_installations_pac) OVER (PARTITION BY dept ORDER BY date_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prediction FROM v_facts"


def two_models(spark, sf):
    mean3 = PR.temporal_split(B.facts(spark, sf), TRAIN_END, VAL_END).select(
        "dept",
        "date_id",
        "split",
        F.col(TARGET).cast("double").alias("label"),
        F.avg(TARGET).over(W.last_k(W.by_entity(), 3, shift=True)).alias("prediction"),
        F.lit("mean3").alias("model"),
    )
    return naive(spark, sf).unionByName(mean3)


@query("m14_model_comparison", side("naive", NAIVE) + " UNION ALL " + side("mean3", MEAN3))
def m14(spark, sf):
    return E.round_doubles(M.compare_models(two_models(spark, sf)), 5)


@query("m15_feature_importance")
def m15(spark, sf):
    prep = prepared(spark, sf)
    table = TR.importance(prep, TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0))
    return table.orderBy(F.desc("importance"), "feature").limit(20)


@query("m16_linear_attribution")
def m16(spark, sf):
    prep = prepared(spark, sf)
    return TR.linear_attribution(prep, TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0))


@query("m17_residuals", f"WITH p AS ({NAIVE}) SELECT dept, date_id, label, prediction, label - prediction AS residual FROM p")
def m17(spark, sf):
    return M.residuals(naive(spark, sf)).select("dept", "date_id", "label", "prediction", "residual")


@query(
    "m17_residual_histogram",
    f"""WITH p AS ({NAIVE}), r AS (SELECT label - prediction AS r FROM p WHERE prediction IS NOT NULL), b AS (SELECT min(r) AS lo, max(r) AS hi FROM r)
SELECT CAST(least(floor((r - lo) / ((hi - lo) / 25)), 24) AS INTEGER) AS bin, count(*) AS n FROM r, b GROUP BY 1""",
)
def m17_hist(spark, sf):
    return A.histogram(M.residuals(naive(spark, sf)), "residual", 25)


@query("m18_overfitting")
def m18(spark, sf):
    prep = prepared(spark, sf)
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0)
    return M.overfitting(M.compare_models(TR.predictions(model, prep.rows, "ridge")))


def test_rmse(scored) -> float:
    row = M.compute_metrics(scored.filter("split = 'test'"), "label", "prediction").first()
    return float(row["rmse"] or 10.0)


@query("m19_seasonal_forecast")
def m19(spark, sf):
    df = features(spark, sf)
    prep = PR.prepare(df, TARGET, TRAIN_END, VAL_END)
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0)
    return FC.forecast_seasonal(df, prep, model, HORIZON, test_rmse(TR.predictions(model, prep.rows, "ridge")))


@query("m20_recursive_forecast")
def m20(spark, sf):
    df = features(spark, sf)
    prep = PR.prepare(df, TARGET, TRAIN_END, VAL_END)
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0)
    rmse = test_rmse(TR.predictions(model, prep.rows, "ridge"))
    return FC.forecast_recursive(df, prep, model, HORIZON, rmse, {"temp_mean": 5.0})


@query("m20_recursive_boosted")
def m20_boosted(spark, sf):
    """Boosted trees, the model forecasts use by default."""
    df = features(spark, sf)
    prep = PR.prepare(df, TARGET, TRAIN_END, VAL_END)
    model = TR.fit_boosting(prep.rows)
    rmse = test_rmse(TR.predictions(model, prep.rows, "boosting"))
    return FC.forecast_recursive(df, prep, model, HORIZON, rmse)


@query(
    "m21_prediction_band",
    f"""WITH p AS ({NAIVE}) SELECT dept, date_id, {he('prediction', 1)} AS prediction, {he('greatest(prediction - CAST(1.96 AS DOUBLE) * 4, 0)', 1)} AS lower, {he('prediction + CAST(1.96 AS DOUBLE) * 4', 1)} AS upper FROM p WHERE prediction IS NOT NULL""",
)
def m21(spark, sf):
    known = naive(spark, sf).filter("prediction IS NOT NULL").select("dept", "date_id", "prediction")
    return FC.with_band(known, 4.0, 1)


@query(
    "m22_advance_calendar",
    f"""WITH l AS (SELECT dept, max(date_id) AS d FROM v_facts GROUP BY dept), f AS (SELECT dept, {next_id('d', 's.k')} AS date_id FROM l, (SELECT unnest(generate_series(1, {HORIZON})) AS k) s)
SELECT dept, date_id, CAST(date_id // 100 AS INTEGER) AS year, CAST(date_id % 100 AS INTEGER) AS month, CAST((date_id % 100 - 1) // 3 + 1 AS INTEGER) AS quarter,
 CAST(date_id % 100 IN (1,2,3,10,11,12) AS INTEGER) AS is_heating, CAST(date_id % 100 IN (6,7,8,9) AS INTEGER) AS is_cooling,
 {he('sin(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_sin, {he('cos(2 * pi() * (date_id % 100) / 12.0)', 4)} AS month_cos FROM f""",
)
def m22(spark, sf):
    rows = FC.advance_calendar(FC.future_rows(B.facts(spark, sf).select("dept", "date_id"), HORIZON))
    return rows.drop("step")


@query(
    "m23_seasonal_profile",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY date_id DESC) AS r FROM v_facts),
s AS (SELECT dept, avg(nb_installations_pac) AS o, avg(nb_installations_pac) FILTER (WHERE r <= 12) AS rc FROM r GROUP BY dept),
m AS (SELECT dept, CAST(date_id % 100 AS INTEGER) AS month, avg(nb_installations_pac) AS mm FROM v_facts GROUP BY 1, 2)
SELECT m.dept, month, {he('mm', 6)} AS month_mean, {he('o', 6)} AS overall, {he('rc', 6)} AS recent, {he('CASE WHEN o > 0 THEN rc / o ELSE 1 END', 6)} AS scale FROM m JOIN s ON m.dept = s.dept""",
)
def m23(spark, sf):
    df = B.facts(spark, sf).withColumn("month", E.month_of("date_id"))
    return E.round_doubles(FC.seasonal_profile(df, TARGET), 6)
