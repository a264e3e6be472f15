import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retropanel.operators import iforest
from retropanel.operators import outliers as O
from retropanel.operators import quality as Q
from retropanel.operators import stats as T
from retropanel.operators import windows as W
from retropanel.operators.quantiles import average_ranks, exact_quantiles


def frame(spark, pdf):
    clean = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    kinds = {"i": "bigint", "f": "double", "O": "string"}
    schema = ", ".join(f"{c} {kinds[pdf[c].dtype.kind]}" for c in pdf.columns)
    return spark.createDataFrame([tuple(x.item() if hasattr(x, "item") else x for x in r) for r in clean], schema)


@pytest.mark.parametrize("accuracy", [10, 100, 10000])
@pytest.mark.parametrize("kind", ["normal", "ties", "tiny", "hot"])
def test_quantiles_are_exact(spark, kind, accuracy):
    rng = np.random.default_rng(3)
    data = {
        "normal": rng.normal(0, 1, 4000),
        "ties": rng.integers(0, 7, 4000).astype(float),
        "tiny": np.array([4.0, 1.0, 10.0]),
        "hot": np.concatenate([np.full(2000, 5.0), rng.normal(0, 10, 2000)]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": data})).repartition(5)
    probs = (0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0)
    row = exact_quantiles(df, ["x"], probs, accuracy=accuracy).first()
    got = [row[f"q{round(p * 100):02d}"] for p in probs]
    np.testing.assert_allclose(got, np.quantile(data, probs), rtol=1e-12, atol=1e-12)


def test_quantiles_per_group_with_a_hot_group(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": ["hot"] * 3000 + ["a"] * 5 + ["b"], "x": rng.normal(0, 1, 3006), "y": rng.integers(0, 9, 3006).astype(float)})
    out = exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], (0.25, 0.5), ["g"]).toPandas()
    for _, r in out.iterrows():
        want = np.quantile(pdf.loc[pdf["g"] == r["g"], r["column"]], (0.25, 0.5))
        np.testing.assert_allclose([r["q25"], r["q50"]], want, rtol=1e-12)
    assert len(out) == 6


def test_quantiles_ignore_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (10.0,), (None,)], "x double")
    r = exact_quantiles(df, ["x"], (0.25, 0.75)).first()
    assert (r["n"], r["q25"], r["q75"]) == (5, 2.0, 4.0)


def test_average_ranks(spark):
    values = np.random.default_rng(5).integers(0, 200, 3000)
    counts = pd.Series(values).value_counts()
    df = spark.createDataFrame([("k", float(v), int(c)) for v, c in counts.items()], "k string, v double, n bigint")
    got = {r["v"]: r["rank"] for r in average_ranks(df, ["k"], "v", "n").collect()}
    want = pd.Series(values).rank()
    assert all(got[float(v)] == r for v, r in zip(values, want))


def test_ranks_of_values_that_span_partitions(spark):
    """A value that fills many range partitions, others at their borders, several keys."""
    from retropanel.operators.quantiles import attach_ranks

    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 3000, p=[0.7, 0.25, 0.05]), "v": rng.choice([0.0, 1.0, 1.0, 1.0, 2.0, 3.5, 7.0], 3000), "o": rng.permutation(3000), "w": rng.integers(1, 4, 3000)})
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["k"], r["o"]): r["rank"] for r in attach_ranks(spark.createDataFrame(pdf).repartition(7), "k", "v", "w", "rank").collect()}
        parts = spark.createDataFrame(pdf).repartitionByRange("k", "v", "o", "w").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert parts > 1 and len(got) == 3000
    for k, rows in pdf.groupby("k"):
        long = rows.loc[rows.index.repeat(rows["w"])]
        want = long["v"].rank().groupby(long["o"]).first()
        assert {o: got[k, o] for o in rows["o"]} == want.to_dict()


def test_ranks_of_long_partitions_are_found_in_chunks(spark):
    """A chunk of a range partition is all that is held: values that fill chunks, span them or end with them, two weights."""
    from retropanel.operators.quantiles import attach_ranks

    rng = np.random.default_rng(13)
    for values, keys in ((rng.integers(0, 9, 4000) ** 3.0, ["a"]), (rng.normal(0, 1, 4000).round(3), ["a", "b", "c"]), (np.repeat([1.0, 2.0, np.nan, 3.0], 1000), ["a"])):
        pdf = pd.DataFrame({"k": rng.choice(keys, 4000), "v": values, "o": rng.permutation(4000), "w": rng.integers(1, 4, 4000), "u": rng.integers(0, 2, 4000)})
        df = spark.createDataFrame(pdf).withColumn("v", F.coalesce("v", F.lit(float("nan")))).repartition(1)
        for key in ("k", None):
            out = attach_ranks(df, key, "v", ["w", "u"], ["rw", "ru"], chunk_rows=64)
            got = out.toPandas().set_index("o").sort_index()
            assert len(got) == 4000
            for _, rows in pdf.groupby("k") if key else [(None, pdf)]:
                for weight, name in (("w", "rw"), ("u", "ru")):
                    long = rows.loc[rows.index.repeat(rows[weight])]
                    want = long["v"].fillna(1e9).rank().groupby(long["o"]).first()
                    assert (got.loc[want.index, name] == want).all()


def test_spearman_sorts_the_rows_once(spark, monkeypatch):
    """However many columns there are, one row of the table is ranked; then one row of each value."""
    ranked = []
    found = T.attach_ranks
    monkeypatch.setattr(T, "attach_ranks", lambda rows, *a, **b: ranked.append(rows.count()) or found(rows, *a, **b))
    rng = np.random.default_rng(14)
    pdf = pd.DataFrame({"t": rng.normal(0, 1, 500), "a": rng.integers(0, 5, 500).astype(float), "b": rng.integers(0, 3, 500).astype(float), "c": 1.0})
    pdf.loc[::7, "a"] = np.nan
    got = {r["column"]: r["rho"] for r in T.spearman(frame(spark, pdf), ["a", "b", "c"], "t").collect()}
    assert ranked == [500, 9] and got["c"] is None
    for c in ("a", "b"):
        p = pdf[[c, "t"]].dropna()
        assert got[c] == pytest.approx(p[c].rank().corr(p["t"].rank()), abs=1e-12)


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"t": rng.normal(0, 1, 400).round(1), "a": rng.normal(0, 1, 400).round(1), "b": rng.integers(0, 4, 400).astype(float)})
    pdf["a"] += pdf["t"]
    pdf.loc[::7, "a"] = np.nan
    got = {r["column"]: r["rho"] for r in T.spearman(frame(spark, pdf), ["a", "b"], "t").collect()}
    for c in ("a", "b"):
        p = pdf[[c, "t"]].dropna()
        assert got[c] == pytest.approx(p[c].rank().corr(p["t"].rank()), abs=1e-12)
    few = frame(spark, pdf.head(50))
    assert T.spearman(few, ["b"], "t").count() == 0


def test_correlations(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(0, 1, (200, 3)), columns=["a", "b", "c"])
    pdf["d"] = pdf["a"] * 2 + 0.01 * pdf["b"]
    pdf.loc[::9, "c"] = np.nan
    df = frame(spark, pdf)
    pairs = T.correlation_pairs(df, ["a", "b", "c", "d"])
    want = pdf.corr()
    for r in pairs.collect():
        assert r["r"] == pytest.approx(want.loc[r["a"], r["b"]], abs=1e-10)
    assert [(r["keep"], r["drop"]) for r in T.keep_drop_advice(T.collinear_pairs(pairs)).collect()] == [("a", "d")]
    constant = df.withColumn("k", F.lit(1.0))
    assert T.target_correlations(constant, ["k"], "a").first()["r"] is None


def test_describe(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, np.nan]})
    r = T.describe(frame(spark, pdf), ["a"]).first()
    want = pdf["a"].describe()
    assert [r[c] for c in ("count", "mean", "min", "max", "q25", "q50", "q75")] == [want[c] for c in ("count", "mean", "min", "max", "25%", "50%", "75%")]
    assert r["std"] == pytest.approx(want["std"]) and r["pct_nan"] == 20.0 and r["dtype"] == "double"


def planted(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"row": np.arange(100), "pac": rng.normal(50, 10, 100), "temp": rng.normal(15, 5, 100), "hdd": rng.uniform(0, 300, 100), "conf": rng.normal(95, 5, 100)})
    pdf.loc[97:, "pac"] = [200.0, 250.0, -10.0]
    pdf.loc[98:, "temp"] = [60.0, -40.0]
    pdf.loc[99, "conf"] = 200.0
    pdf.loc[5, "hdd"] = np.nan
    return pdf, frame(spark, pdf)


COLS = ["pac", "temp", "hdd", "conf"]


def brute_iqr(pdf, c, k=1.5):
    s = pdf[c].dropna()
    a, b = s.quantile(0.25), s.quantile(0.75)
    return int(((s < a - k * (b - a)) | (s > b + k * (b - a))).sum())


def test_planted_outliers(spark):
    pdf, df = planted(spark)
    got = {r["column"]: r["n_outliers"] for r in O.iqr_report(df, COLS).collect()}
    assert got == {c: brute_iqr(pdf, c) for c in COLS if brute_iqr(pdf, c)}
    assert got["pac"] >= 2
    strict = {r["column"]: r["n_outliers"] for r in O.iqr_report(df, COLS, 1.0).collect()}
    assert all(strict[c] >= n for c, n in got.items())


def test_zscore_matches_brute_force_and_skips_flat_columns(spark):
    pdf, df = planted(spark)
    got = {r["column"]: r["n_outliers"] for r in O.zscore_report(df, COLS).collect()}
    for c in COLS:
        s = pdf[c].dropna()
        mad = (s - s.median()).abs().median()
        n = int(((0.6745 * (s - s.median()) / mad).abs() > 3.5).sum())
        assert got.get(c, 0) == n
    flat = df.withColumn("flat", F.when(F.col("row") < 60, 1.0).otherwise(F.col("row") * 1.0))
    assert O.zscore_report(flat, ["flat"]).count() == 0


def test_votes_and_treatments(spark):
    pdf, df = planted(spark)
    flagged = O.detect_and_flag(df, ["row"], COLS)
    rows = {r["row"]: r for r in flagged.collect()}
    assert len(rows) == 100
    assert all(rows[i]["_outlier_consensus"] for i in (97, 98, 99))
    assert all(r["_outlier_consensus"] == (r["_outlier_score"] >= 2) for r in rows.values())
    n_forest = sum(r["_outlier_iforest"] for r in rows.values())
    assert 4 <= n_forest <= 6
    again = {r["row"]: r["_outlier_iforest"] for r in O.detect_and_flag(df, ["row"], COLS).collect()}
    assert again == {k: r["_outlier_iforest"] for k, r in rows.items()}
    assert O.treat(flagged, "clip", COLS).count() == 100
    assert O.treat(flagged, "remove").count() == 100 - sum(r["_outlier_consensus"] for r in rows.values())
    assert O.iqr_report(O.treat(flagged, "clip", COLS), ["pac"]).count() in (0, 1)
    top = O.treat(flagged, "clip", COLS).agg(F.max("pac")).first()[0]
    s = pdf["pac"]
    assert top == pytest.approx(s.quantile(0.75) + 1.5 * (s.quantile(0.75) - s.quantile(0.25)))
    assert {r["method"] for r in O.vote_summary(flagged).collect()} == {"_outlier_iqr", "_outlier_zscore", "_outlier_iforest", "_outlier_consensus"}


def test_clean_data_has_few_outliers(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, pd.DataFrame({"row": np.arange(50), "value_a": rng.normal(100, 5, 50), "value_b": rng.normal(50, 3, 50)}))
    assert sum(r["n_outliers"] for r in O.iqr_report(df, ["value_a", "value_b"]).collect()) < 5


def test_forest_scores_rise_away_from_the_crowd(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"row": np.arange(600), "x": rng.normal(0, 1, 600), "y": rng.normal(0, 1, 600)})
    pdf.loc[0, ["x", "y"]] = [9.0, 9.0]
    out = iforest.score(frame(spark, pdf), ["x", "y"], ["row"]).toPandas().set_index("row")["anomaly_score"]
    assert out.idxmax() == 0 and out[0] > 0.65 and out.between(0, 1).all()


def test_tree_paths_isolate_every_point_or_count_the_rest():
    points = np.random.default_rng(0).normal(size=(64, 2))
    nodes = iforest.grow_tree(points, np.random.default_rng(1))
    table = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "depth"]).assign(tree=0)
    lengths = iforest.path_lengths(points, iforest.pack(table))
    assert lengths.min() >= 1 and lengths.mean() == pytest.approx(iforest.expected_depth(64), rel=0.35)


@pytest.mark.parametrize("values,want", [([100, 100, 100, 300], ["spike"]), ([100, 100, 20], ["drop"]), ([100, 105, 98, 103], []), ([0, 5], ["spike"])])
def test_temporal_anomalies(spark, values, want):
    df = spark.createDataFrame([("69", 202301 + i, v) for i, v in enumerate(values)], "dept string, date_id int, v int")
    assert [r["type"] for r in W.temporal_anomalies(df, "v").collect()] == want


def test_analysed_columns(spark):
    df = spark.createDataFrame([(1, 2022, 3.0, "x", 1)], "date_id int, year int, v double, dept string, _flag int")
    assert O.analysed_columns(df) == ["v"]


def test_quality_checks_and_gate(spark):
    df = spark.createDataFrame([("2023-01-01", "69", 50.0), ("2023-01-02", "69", None)], "time string, dept string, t double")
    checks = Q.validate(df, "weather", ["time", "city"], Q.null_share_checks(df) + Q.range_checks(["t"], -30, 40) + [Q.rows_check(10)])
    got = {r["check"]: r["status"] for r in checks.collect()}
    assert got["null_share:t"] == "warning" and got["max:t"] == "warning" and got["min:t"] == "pass"
    assert got["rows"] == "error" and got["missing_columns"] == "error"
    with pytest.raises(ValueError, match="rows"):
        Q.gate(checks)


def test_gaps_and_manifest(spark):
    df = spark.createDataFrame([("a", 202311), ("a", 202312), ("a", 202402)], "dept string, date_id int")
    assert [(r["gap_after"], r["gap_before"]) for r in Q.period_gaps(df, ["dept"]).collect()] == [(202312, 202402)]
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "name string, hash int, size int")
    new = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 1, 1)], "name string, hash int, size int")
    assert {r["name"]: r["reason"] for r in Q.manifest_changes(old, new).collect()} == {"b": "modified", "c": "new"}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.range(100).withColumn("v", F.col("id") * 2)
    mark = lambda df: Q.stage_record("s", a, df).first()["fingerprint"]
    assert mark(a) == mark(a.orderBy(F.desc("id"))) != mark(a.withColumn("v", F.col("id")))


def test_brackets_are_narrowed_until_few_rows_are_inside(spark, monkeypatch):
    from retropanel.operators import quantiles as Q

    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=40_000), np.full(10_000, 0.25), [np.nan]])
    y = np.round(rng.normal(size=len(x)), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).replace(float("nan"), None)
    seen = []
    narrow = Q._narrow
    monkeypatch.setattr(Q, "FEW_ROWS", 20)
    monkeypatch.setattr(Q, "_narrow", lambda w, b, a: (narrow(w, b, a), seen.extend(b))[0])
    got = {r["column"]: r for r in exact_quantiles(df, ["x", "y"], (0.1, 0.5, 0.9), accuracy=100).collect()}
    for name, values in (("x", x[~np.isnan(x)]), ("y", y)):
        assert [got[name][q] for q in ("q10", "q50", "q90")] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9]).tolist(), abs=1e-12)
    # a bracket is small, or one or two values fill it
    assert all(b.inside <= 20 or b.lo == b.hi or b.column == "y" for b in seen)


def test_many_columns_are_ranked_as_rows(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({f"c{i:02d}": rng.normal(size=3000).round(i % 4) for i in range(20)})
    plan = exact_quantiles(spark.createDataFrame(pdf), list(pdf), (0.25, 0.75))
    got = {r["column"]: (r["q25"], r["q75"]) for r in plan.collect()}
    for c in pdf:
        assert got[c] == pytest.approx(tuple(np.quantile(pdf[c], [0.25, 0.75])), abs=1e-12)


def test_wide_matrix_equals_pairs(spark):
    from retropanel.operators import stats as T

    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({f"c{i:02d}": rng.normal(1e6 * i, 1 + i, 800) for i in range(14)})
    pdf["c03"] = 5.0
    pdf.loc[rng.random(800) < 0.3, "c05"] = np.nan
    pdf["c06"] = pdf["c02"] * 2 + rng.normal(size=800) * 0.1
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r["a"], r["b"]): r["r"] for r in T.correlation_pairs(df, list(pdf)).collect()}
    want = pdf.corr()
    assert len(got) == 14 * 13 // 2
    for (a, b), r in got.items():
        assert r is None if "c03" in (a, b) else r == pytest.approx(want.loc[a, b], abs=1e-9)
