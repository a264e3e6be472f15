import datetime as dt

import numpy as np

import pytest
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.operators import aggregates as A
from retropanel.operators import joins as J
from retropanel.plans import features as P
from retropanel.plans import panel as PL
from retropanel.plans import process
from retropanel.queries import bindings as B
from retropanel.sources import sinks as K
from retropanel.sources.dimensions import departments_for_scope, geo_dimension


def certs(spark):
    rows = [(202200 + m, d, *f) for m in range(7, 13) for d in ("69", "38") for f in ((1, 0, 1), (0, 1, 0))]
    return spark.createDataFrame(rows, "date_id int, code_departement_ban string, is_pac int, is_clim int, is_classe_ab int")


def weather(spark):
    rows = []
    for d in ("69", "38"):
        for i in range(60):
            day = dt.date(2022, 7, 1) + dt.timedelta(i)
            rows.append((day, d, 36.0 if i % 10 == 0 else 30.0, -8.0 if i % 15 == 0 else 12.0, 20.0, 1.0))
    return spark.createDataFrame(rows, "date date, dept string, temperature_2m_max double, temperature_2m_min double, temperature_2m_mean double, precipitation_sum double")


def permits(spark):
    rows = [("2022-07", "69", 10), ("2022-07-15", "69", 5), ("2022-08", "1", 7)]
    return spark.createDataFrame(rows, "DATE_REELLE_AUTORISATION string, DEP_CODE string, NB_LGT_TOT_CREES int")


def attributes(spark):
    rows = [("69", 23500, 3200, 800000, 35.2), ("38", 22000, 2800, 550000, 42.8)]
    return spark.createDataFrame(rows, "dept string, revenu_median int, prix_m2_median int, nb_logements_total int, pct_maisons double")


def test_target_counts(spark):
    out = PL.certificate_target(certs(spark)).collect()
    assert len(out) == 12
    assert {tuple(r[c] for c in S.COUNT_COLUMNS) for r in out} == {(2, 1, 1, 1)}
    assert {(r["pct_pac"], r["pct_clim"]) for r in out} == {(50.0, 50.0)}


def test_weather_months_and_day_flags(spark):
    out = {(r["date_id"], r["dept"]): r for r in PL.weather_features(weather(spark)).collect()}
    july = out[(202207, "69")]
    assert july["nb_jours_canicule"] == 4 and july["nb_jours_gel"] == 3 and july["nb_jours_pac_inefficient"] == 3
    assert july["precipitation_sum"] == 31.0 and july["temp_mean"] == 20.0


def test_sum_over_nothing_is_zero(spark):
    df = spark.createDataFrame([(202301, "01", None)], "date_id int, dept string, precipitation_sum double")
    assert A.monthly_weather(df).first()["precipitation_sum"] == 0.0


def test_permits_both_formats_are_summed_and_padded(spark):
    out = {(r["date_id"], r["dept"]): r["nb_logements_autorises"] for r in PL.permit_features(permits(spark)).collect()}
    assert out == {(202207, "69"): 15, (202208, "01"): 7}


def test_panel_keeps_base_rows_and_unique_keys(spark):
    geo = geo_dimension(spark)
    out = PL.build_panel(certs(spark), geo, weather(spark), permits=permits(spark), attributes=attributes(spark), start=202208)
    got = out.collect()
    assert len(got) == 10 and len({(r["date_id"], r["dept"]) for r in got}) == 10
    r = next(x for x in got if x["dept"] == "69")
    assert r["pac_per_1000_logements"] == np.round(1 / 800000 * 1000, 4)
    assert r["altitude"] == 175.0 and r["dept_name"] == "Rhone"


def test_rates_absent_without_stock(spark):
    assert "pac_per_1000_logements" not in PL.build_panel(certs(spark), geo_dimension(spark)).columns


def test_suffix_on_collision(spark):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    assert J.left_with_suffix(left, left.withColumn("v", F.lit(3)), ["k"], "_x").columns == ["k", "v", "v_x"]


def test_geography(spark):
    geo = geo_dimension(spark)
    assert geo.count() == 96 and geo.select("dept").distinct().count() == 96
    assert len(departments_for_scope("84")) == 12 and len(departments_for_scope("fr")) == 96


def small_panel(spark, **extra):
    rows = []
    for d, alt, houses in (("69", 175.0, 32.0), ("38", 212.0, 52.0)):
        for i in range(24):
            y, m = 2022 + i // 12, i % 12 + 1
            rows.append((y * 100 + m, d, 100 + i, 10 + i, 5, 3, 10.0 + i % 12, 200.0 - i, float(i), 95.0, 98.0, 101.0, y, m, i % 12, 11 - i % 12, i % 4, alt, houses))
    df = spark.createDataFrame(
        rows,
        "date_id int, dept string, nb_dpe_total int, nb_installations_pac int, nb_installations_clim int, nb_dpe_classe_ab int, temp_mean double, hdd_sum double, cdd_sum double, "
        "confiance_menages double, climat_affaires_bat double, ipi_hvac_c28 double, year int, month int, nb_jours_canicule int, nb_jours_gel int, nb_jours_pac_inefficient int, altitude double, pct_maisons double",
    )
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def test_features(spark):
    out = {(r["dept"], r["date_id"]): r for r in P.engineer(small_panel(spark)).collect()}
    first, third = out[("69", 202201)], out[("69", 202203)]
    assert first["nb_dpe_total_lag_1m"] is None and third["nb_dpe_total_lag_1m"] == 101
    assert first["nb_dpe_total_rmean_3m"] == 100.0 and first["nb_dpe_total_rstd_3m"] is None
    assert third["nb_dpe_total_rmean_3m"] == 101.0 and third["nb_dpe_total_rstd_3m"] == 1.0
    assert third["nb_installations_pac_diff_1m"] == 1 and third["year_trend"] == 0
    for r in out.values():
        assert 1.0 <= r["cop_proxy"] <= 5.0 and 0.0 <= r["pac_viability_score"] <= 1.0
        assert r["jours_extremes"] == r["nb_jours_canicule"] + r["nb_jours_gel"]
        assert r["pct_jours_pac_inefficient"] == round(r["nb_jours_pac_inefficient"] / 30 * 100, 1)
    assert first["pct_valid_features"] < third["pct_valid_features"] <= 100.0


def test_shifted_windows_leave_the_current_month_out(spark):
    cur = {(r["dept"], r["date_id"]): r for r in P.engineer(small_panel(spark), shift_target_windows=True).collect()}
    r = cur[("69", 202204)]
    assert r["nb_dpe_total_rmean_3m"] == 101.0 and r["nb_dpe_total_diff_1m"] == 1
    assert r["temp_mean_rmean_3m"] == 12.0
    assert r["nb_dpe_total_pct_1m"] == round((102 / 101 - 1) * 100, 2)


@pytest.mark.parametrize("alt,mountain,want", [(900.0, 0.0, 1), (100.0, 60.0, 1), (100.0, 10.0, 0)])
def test_mountain_flag_prefers_mean_altitude(spark, alt, mountain, want):
    df = small_panel(spark, altitude_mean=alt, pct_zone_montagne=mountain)
    assert P.heat_pump_efficiency(df, P.scaling_maxima(df)).first()["is_mountain"] == want


def test_efficiency_falls_with_frost(spark):
    df = small_panel(spark)
    rows = P.heat_pump_efficiency(df, P.scaling_maxima(df)).filter("dept = '69'").orderBy("nb_jours_gel").collect()
    cops = [r["cop_proxy"] for r in rows]
    assert cops == sorted(cops, reverse=True)


def test_features_tolerate_missing_columns(spark):
    df = small_panel(spark).select("date_id", "dept", "nb_dpe_total")
    out = P.engineer(df)
    assert "nb_dpe_total_lag_1m" in out.columns and "cop_proxy" not in out.columns
    assert out.count() == 48


def test_series_features_use_one_shuffle(spark):
    plan = P.series_features(small_panel(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_whole_chain(spark, sf, tmp_path):
    out = process.run(B.sources(spark, sf), geo_dimension(spark), str(tmp_path), B.CFG)
    panel = spark.read.parquet(f"{tmp_path}/panel")
    assert out.count() == panel.count() == B.panel(spark, sf).count()
    assert {"_outlier_consensus", "nb_dpe_total_lag_1m", "pct_valid_features"} <= set(out.columns)


def test_incremental_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    K.incremental_save(a, path)
    again = K.incremental_save(spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string"), path)
    assert sorted(tuple(r) for r in again.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    up = str(tmp_path / "u")
    K.keyed_upsert(a, up, ["k"], 1)
    done = K.keyed_upsert(spark.createDataFrame([(2, "new")], "k int, v string"), up, ["k"], 2)
    assert {r["k"]: r["v"] for r in done.collect()} == {1: "x", 2: "new"}


def test_year_filter_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "y")
    df = spark.range(1000).select("id", F.expr("date_add(DATE '2020-01-01', cast(id as int))").alias("day"))
    K.write_by_year(df, path, "day")
    got = K.read_by_year(spark, path, "day", "2021-01-01", "2021-12-31")
    assert got.count() == 365
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_bucketed_tables_join_in_place(spark, tmp_path):
    """Facts, weather and permits by (date_id, dept): two joins and an aggregate by the keys, no exchange."""
    left = spark.range(500).selectExpr("cast(id % 50 AS int) AS date_id", "cast(id % 7 AS string) AS dept", "id AS v").dropDuplicates(["date_id", "dept"])
    one, two, three = (K.write_bucketed(left.withColumnRenamed("v", n), str(tmp_path / n), ["date_id", "dept"], 4) for n in "abc")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = one.join(two, ["date_id", "dept"], "left").join(three, ["date_id", "dept"]).groupBy("date_id", "dept").agg({"a": "sum", "b": "sum", "c": "sum"})
        assert out.count() == left.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
