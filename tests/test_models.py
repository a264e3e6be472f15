import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from retropanel.models import forecast as FC
from retropanel.models import metrics as M
from retropanel.models import prepare as PR
from retropanel.models import ridge as RI
from retropanel.models import search as SE
from retropanel.models import train as TR
from retropanel.plans.features import engineer


def panel(spark, months=48, depts=("69", "38", "01")):
    rng = np.random.default_rng(42)
    rows = []
    for k, d in enumerate(depts):
        for i in range(months):
            y, m = 2021 + i // 12, i % 12 + 1
            temp = 12 - 9 * math.cos(2 * math.pi * m / 12) + rng.normal(0, 1)
            pac = max(0.0, 60 + 10 * k + 0.4 * i - 1.2 * temp + rng.normal(0, 2))
            rows.append((y * 100 + m, d, int(200 + pac), int(pac), int(pac / 3), int(pac / 5), float(temp), float(max(0, 18 - temp) * 30), float(max(0, temp - 18) * 30), 95.0 + rng.normal(), y, m))
    return spark.createDataFrame(
        rows,
        "date_id int, dept string, nb_dpe_total int, nb_installations_pac int, nb_installations_clim int, nb_dpe_classe_ab int, temp_mean double, hdd_sum double, cdd_sum double, confiance_menages double, year int, month int",
    )


TARGET = "nb_installations_pac"


@pytest.fixture(scope="module")
def features(spark):
    return engineer(panel(spark), shift_target_windows=True).cache()


@pytest.fixture(scope="module")
def prep(features):
    return PR.prepare(features, TARGET, 202306, 202312)


def test_split_has_no_overlap(spark):
    s = PR.temporal_split(panel(spark), 202306, 202312).groupBy("split").agg(F.min("date_id").alias("a"), F.max("date_id").alias("b"))
    got = {r["split"]: (r["a"], r["b"]) for r in s.collect()}
    assert got == {"train": (202101, 202306), "val": (202307, 202312), "test": (202401, 202412)}


def test_leaking_columns_are_left_out(features):
    df = features.withColumns({"pct_pac": F.lit(1.0), "_outlier_score": F.lit(1)})
    names = PR.select_features(df, TARGET)
    assert not {"pct_pac", "_outlier_score", "nb_dpe_total", "date_id", TARGET} & set(names)
    assert f"{TARGET}_lag_1m" in names
    exo = PR.select_features(df, TARGET, without_target_lags=True)
    assert not [n for n in exo if n.startswith(TARGET)] and "temp_mean" in exo


def test_imputation_and_scaling_use_training_rows_only(spark):
    rows = [(202301, "a", 1.0, 1.0), (202302, "a", 3.0, 2.0), (202303, "a", None, 3.0), (202401, "a", None, 4.0), (202402, "a", 100.0, 5.0)]
    df = spark.createDataFrame([(*r, None) for r in rows], "date_id int, dept string, x double, nb_installations_pac double, nothing double")
    p = PR.prepare(df, TARGET, 202303, 202312)
    assert p.features == ["x"] and p.medians == {"x": 2.0}


def test_metrics(spark):
    nan = float("nan")
    check = lambda data: M.compute_metrics(spark.createDataFrame(data, "y double, p double"), "y", "p").first()
    perfect = check([(1.0, 1.0), (2.0, 2.0)])
    assert (perfect["rmse"], perfect["r2"]) == (0.0, 1.0)
    mixed = check([(100.0, 110.0), (0.0, 5.0), (None, 1.0), (2.0, nan)])
    assert mixed["n"] == 2 and mixed["mape"] == pytest.approx(10.0) and mixed["rmse"] >= mixed["mae"]
    empty = check([(None, 1.0)])
    assert empty["rmse"] is None and empty["mape"] is None and empty["r2"] is None


def test_metrics_match_formulas(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(50, 10, 300), rng.normal(50, 12, 300)
    r = M.compute_metrics(spark.createDataFrame(pd.DataFrame({"y": y, "p": p})), "y", "p").first()
    assert r["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert r["mape"] == pytest.approx(100 * np.abs((y - p) / y).mean())


@pytest.mark.parametrize("alpha", [0.01, 1.0, 50.0])
def test_ridge_equals_the_closed_form(spark, alpha):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (120, 4)) * np.array([1, 5, 0.2, 2])
    y = x @ np.array([1.0, -2.0, 3.0, 0.5]) + 7 + rng.normal(0, 1, 120)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, d double, label double")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)
    model = TR.fit_ridge(df, alpha)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-6, atol=1e-8)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-6)


def test_folds_expand_in_time(prep):
    folded = PR.expanding_folds(prep.rows.filter("split = 'train'"))
    spans = {r["block"]: (r["a"], r["b"]) for r in folded.groupBy("block").agg(F.min("date_id").alias("a"), F.max("date_id").alias("b")).collect()}
    assert sorted(spans) == [0, 1, 2, 3]
    assert all(spans[k][1] < spans[k + 1][0] for k in range(3))


def test_ridge_learns_and_reports(prep):
    scores = TR.ridge_alpha_scores(prep, (0.1, 10.0))
    alpha = TR.select_alpha(scores)
    assert alpha in (0.1, 10.0)
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), alpha)
    scored = TR.predictions(model, prep.rows, "ridge")
    assert scored.agg(F.min("prediction")).first()[0] >= 0
    table = M.compare_models(scored)
    assert table.first()["train_r2"] > 0.8
    assert M.overfitting(table).first()["verdict"] in ("HEALTHY", "MODERATE", "OVERFITTING RISK")
    assert TR.importance(prep, model).count() == len(prep.features)
    assert TR.linear_attribution(prep, model).filter("attribution > 0").count() > 3


def test_seasonal_models_skip_short_histories(spark):
    short = panel(spark, 6, ("02",)).unionByName(panel(spark))
    out = TR.fit_seasonal(PR.temporal_split(short, 202306, 202312), TARGET)
    assert {r[0] for r in out.select("dept").distinct().collect()} == {"69", "38", "01"}
    r2 = M.compute_metrics(out.filter("split = 'train'"), "label", "prediction").first()["r2"]
    assert r2 > 0.7


def test_best_row_ignores_null_and_nan(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", None), ("c", 2.0), ("d", 3.0)], "model string, rmse double")
    assert M.best_row(df, "rmse", ["model"]).first()["model"] == "c"


def brute_seasonal(pdf, horizon):
    """Month by month with a growing buffer, for one department."""
    pdf = pdf.sort_values("date_id")
    hist = list(pdf[TARGET].tail(24).astype(float))
    mean = pdf.groupby("month")[TARGET].mean()
    scale = pdf[TARGET].tail(12).mean() / pdf[TARGET].mean()
    last, out = int(pdf["date_id"].iloc[-1]), []
    for step in range(1, horizon + 1):
        total = last // 100 * 12 + last % 100 - 1 + step
        month = total % 12 + 1
        out.append(
            {
                "date_id": total // 12 * 100 + month,
                f"{TARGET}_lag_1m": hist[-1],
                f"{TARGET}_lag_3m": hist[-3],
                f"{TARGET}_lag_6m": hist[-6],
                f"{TARGET}_rmean_3m": np.mean(hist[-3:]),
                f"{TARGET}_rstd_6m": np.std(hist[-6:]),
                f"{TARGET}_diff_1m": hist[-1] - hist[-2],
                f"{TARGET}_pct_1m": np.clip((hist[-1] - hist[-2]) / hist[-2] * 100, -200, 500),
                "temp_mean": pdf.groupby("month")["temp_mean"].mean()[month],
            }
        )
        hist.append(mean[month] * scale)
    return pd.DataFrame(out).set_index("date_id")


def test_seasonal_inputs_match_a_loop(features):
    names = PR.select_features(features, TARGET)
    got = FC.seasonal_features(features, names, 14).toPandas()
    pdf = features.toPandas()
    for dept in ("69", "01"):
        want = brute_seasonal(pdf[pdf["dept"] == dept], 14)
        have = got[got["dept"] == dept].set_index("date_id").sort_index()
        for c in want.columns:
            np.testing.assert_allclose(have[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-9, err_msg=c)


def test_forecasts(features, prep):
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0)
    out = FC.forecast_seasonal(features, prep, model, 12, 5.0).collect()
    assert len(out) == 3 * 12 and all(0 <= r["lower"] <= r["prediction"] <= r["upper"] for r in out)
    assert {r["date_id"] for r in out} == {202500 + m for m in range(1, 13)}
    rec = FC.forecast_recursive(features, prep, model, 4, 5.0).collect()
    assert len(rec) == 12


def test_recursive_forecast_matches_a_loop(features, prep):
    model = TR.fit_ridge(prep.rows.filter("split = 'train'"), 1.0)
    got = {(r["dept"], r["step"]): r["prediction"] for r in FC.forecast_recursive(features, prep, model, 5, 1.0).collect()}
    rows = PR.impute(FC.advance_calendar(FC.future_rows(features, 5), F.lit(2021)), prep.medians).toPandas()
    med, rng_ = np.array(prep.scaler.median), np.array(prep.scaler.range)
    coef = model.coefficients.toArray()
    for dept in ("69", "38"):
        x = rows[rows["dept"] == dept].sort_values("step")[prep.features].to_numpy(dtype=float)
        lag, prev = prep.features.index(f"{TARGET}_lag_1m"), None
        for i in range(5):
            if prev is not None:
                x[i, lag] = prev
            scaled = np.where(rng_ != 0, (x[i] - med) / np.where(rng_ == 0, 1, rng_), 0.0)
            prev = max(float(scaled @ coef + model.intercept), 0.0)
            assert got[(dept, i + 1)] == pytest.approx(round(prev, 2), abs=0.011)


def test_gram_scores_equal_fitted_folds(prep):
    """Every fold and penalty from the rows themselves, and near the library's iterative fits."""
    folded = PR.expanding_folds(prep.rows.filter("split = 'train'")).cache()
    data = [(r["block"], np.append(r["features"].toArray(), r["label"])) for r in folded.select("block", "features", "label").collect()]
    for alpha, error in RI.alpha_errors(folded, (0.01, 1.0, 100.0)):
        errors = []
        for k in (1, 2, 3):
            train, held = (np.array([v for b, v in data if keep(b)]) for keep in (lambda b: b < k, lambda b: b == k))
            x, y = train[:, :-1] - train[:, :-1].mean(0), train[:, -1] - train[:, -1].mean()
            beta = np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ y)
            errors.append(np.sqrt(np.mean((held[:, -1] - train[:, -1].mean() - (held[:, :-1] - train[:, :-1].mean(0)) @ beta) ** 2)))
        assert error == pytest.approx(np.mean(errors), rel=1e-8)
        got = {r["fold"]: r for r in RI.fold_metrics(folded, alpha).collect()}
        assert [got[k]["rmse"] for k in (1, 2, 3)] == pytest.approx(errors, rel=1e-8)
        for r in TR.cross_validate(folded, lambda t, a=alpha: TR.fit_ridge(t, a)).collect() if alpha >= 1 else ():
            for m in ("n", "rmse", "mae", "mape", "r2"):
                assert got[r["fold"]][m] == pytest.approx(r[m], rel=5e-3), (alpha, r["fold"], m)
    assert RI.alpha_errors(folded.limit(0), (1.0,)) == [(1.0, None)]
    assert RI.fold_metrics(folded.limit(0), 1.0).count() == 0


def test_one_scan_gathers_all_folds(spark, prep):
    """The moments read the rows once, however many penalties and folds there are."""
    folded = PR.expanding_folds(prep.rows.filter("split = 'train'")).select("block", "label", "features")
    read = spark.sparkContext.accumulator(0)
    schema = folded.schema

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    spied = folded.mapInArrow(counted, schema)
    RI.alpha_errors(spied, (0.1, 1.0, 10.0, 100.0))
    assert read.value == folded.count()


def test_halving_keeps_the_best(spark):
    """A made-up error surface: settings are dropped rung by rung, the best one gets all its rounds."""
    calls = []

    class Scored:
        def __init__(self, by):
            self.by = by

        def transform(self, rows):
            return rows.withColumn("prediction", F.col("label") + F.lit(self.by))

    def fit(rows, setting, rounds):
        calls.append((setting["a"], rounds))
        return Scored(abs(setting["a"] - 7) + 1 / rounds)

    rows = spark.createDataFrame([(k, float(k)) for k in range(20)], "id int, label double")
    folds = [(rows, rows.limit(10)), (rows, rows)]
    grid = [{"a": a} for a in range(20)]
    out = SE.successive_halving(folds, grid, fit, rounds=160, keep=4, least=5, parallelism=3)
    assert SE.rungs(160, 20, 4, 5) == [(20, 10), (5, 40), (1, 160)]
    assert [o.place for o in out] == list(range(1, 21)) and out[0].setting == {"a": 7} and out[0].rounds == 160
    assert {o.setting["a"] for o in out[:5]} == {5, 6, 7, 8, 9} and out[0].rmse == pytest.approx(1 / 160)
    assert sorted(o.rounds for o in out) == [10] * 15 + [40] * 4 + [160]
    assert len(calls) == 2 * (20 + 5 + 1)
    frame = SE.outcome_frame(spark, out, {"a": "a"}).collect()
    assert [r["place"] for r in frame if r["best"]] == [1] and len(frame) == 20
    with pytest.raises(ZeroDivisionError):  # a failed fit is not passed over
        SE.successive_halving(folds, grid[:2], lambda t, s, n: 1 / 0, rounds=10)


def test_grid_of_trees(prep):
    """A small grid of the real fits; a setting's error is that of fitting it alone."""
    grid = [{"maxDepth": d, "stepSize": s, "minInstancesPerNode": 5} for d in (2, 3) for s in (0.1, 0.3)]
    out = TR.boosting_search(prep, grid, rounds=8, least=8, parallelism=4)
    assert len(out) == 4 and [o.rmse for o in out] == sorted(o.rmse for o in out) and {o.rounds for o in out} == {8}
    folds = SE.fold_parts(prep.rows.filter("split = 'train'"), ["label", "raw"])
    alone = [SE.fold_error(TR.boost, out[0].setting, 8, t, v) for t, v in folds]
    assert out[0].rmse == pytest.approx(np.mean(alone), rel=1e-9)


def test_flat_trees_score_like_the_library(prep):
    from retropanel.models.trees import flat_trees

    model = TR.fit_boosting(prep.rows, maxIter=15, minInstancesPerNode=3)
    rows = model.transform(prep.rows).select("raw", "prediction").collect()
    got = flat_trees(model).predict(np.array([r["raw"].toArray() for r in rows]))
    np.testing.assert_allclose(got, [r["prediction"] for r in rows], rtol=1e-12)


def test_boosted_forecast_is_one_walk(features, prep):
    """Every department and month in one pass, equal to scoring month after month."""
    model = TR.fit_boosting(prep.rows, maxIter=10, minInstancesPerNode=3)
    for overrides in (None, {"temp_mean": 5.0}, {f"{TARGET}_lag_1m": 50.0}):
        one = FC.forecast_recursive(features, prep, model, 5, 4.0, overrides).orderBy("dept", "date_id").collect()
        steps = FC._recursive_steps(features, prep, model, 5, 4.0, overrides).orderBy("dept", "date_id").collect()
        assert len(one) == 15 and [tuple(r) for r in one] == [tuple(r) for r in steps]


def test_a_planted_trend_break_is_found(spark):
    """The slope turns in month 40 of 72; a straight trend cannot follow, and every department gets its model."""
    rows = []
    for k, dept in enumerate(("01", "38", "69")):
        for t in range(84):
            level = 100 + 3 * t if t < 40 else 220 - 2 * (t - 40)
            rows.append((201801 + t // 12 * 100 + t % 12, dept, float(level + 10 * k + 5 * math.sin(2 * math.pi * t / 12)), "train" if t < 72 else "test"))
    df = spark.createDataFrame(rows, "date_id int, dept string, y double, split string")
    error = lambda s: {r["dept"]: r["e"] for r in TR.fit_seasonal(df, "y", (), stiffness=s).filter("split = 'test'").groupBy("dept").agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("e")).collect()}
    bent, straight = error(1.0), error(1e9)
    assert set(bent) == {"01", "38", "69"}
    assert max(bent.values()) < 12 and min(straight.values()) > 40
    assert len(TR.trend_breaks(np.arange(20.0))) == 0 and TR.trend_breaks(np.arange(72.0)).max() <= 0.8 * 71
