import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retropanel.functions import expr as E
from retropanel.operators import windows as W


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value,digits,want", [(0.125, 2, 0.12), (2.675, 2, 2.68), (-0.5, 0, 0.0), (2.5, 0, 2.0)])
def test_half_even(spark, value, digits, want):
    assert one(spark, E.half_even(F.lit(value), digits)) == want
    assert float(np.round(value, digits)) == want


def test_half_even_matches_numpy_on_random_values(spark):
    values = np.random.default_rng(1).normal(0, 100, 500).round(3)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).select("x", E.half_even("x", 2).alias("r")).toPandas()
    assert (df["r"].to_numpy() == np.round(df["x"].to_numpy(), 2)).all()


def test_clip_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (3.0,), (99.0,)], "x double")
    got = [r[0] for r in df.select(E.clip("x", 0.0, 10.0)).collect()]
    assert got == [None, 0.0, 3.0, 10.0]


@pytest.mark.parametrize("code,want", [("1", "01"), (" 2A ", "2A"), ("123", "123"), ("69", "69")])
def test_pad_code(spark, code, want):
    assert one(spark, E.pad_code(F.lit(code))) == want


def test_known_code(spark):
    df = spark.createDataFrame([("1",), ("2A",), ("99",), (None,)], "c string")
    assert [r[0] for r in df.select(E.known_code("c", ["01", "2A"])).collect()] == [True, True, False, False]


@pytest.mark.parametrize("text,want", [("2024-03", 202403), ("2024-03-17", 202403), ("2019Q1", None), ("", None)])
def test_period_to_id(spark, text, want):
    assert one(spark, E.period_to_id(F.lit(text))) == want


@pytest.mark.parametrize("text,want", [("2024-03", True), ("2019Q1", False), ("2024-03-01", False), (None, False)])
def test_monthly_period(spark, text, want):
    assert one(spark, E.is_monthly(F.lit(text).cast("string"))) is want


@pytest.mark.parametrize("start,step,want", [(202312, 1, 202401), (202401, -1, 202312), (202405, 20, 202601), (202405, 0, 202405)])
def test_shift_month(spark, start, step, want):
    assert one(spark, E.shift_month(F.lit(start), step)) == want


@pytest.mark.parametrize(
    "text,want",
    [("PAC air/eau", 1), ("installation en PAC", 1), ("Pompe a chaleur", 1), ("Ballon thermodynamique", 1), ("Chaudiere gaz", 0), (None, 0), ("IMPACT", 0), ("compact unit", 0), ("COMPAC", 1)],
)
def test_heat_pump_pattern(spark, text, want):
    assert one(spark, E.is_heat_pump(F.lit(text).cast("string"), F.lit(None).cast("string"))) == want


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("x",), ("2024-02-28",)], "d string")
    assert [r[0] is None for r in df.select(E.parse_date("d")).collect()] == [True, True, False]


def test_percent_change_vector(spark):
    values = [0.0, 5.0, 0.0, 0.0, None, 4.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "dept string, date_id int, x double")
    got = df.withColumns(W.pct_changes(["x"], W.by_entity())).orderBy("date_id")
    assert [r["x_pct_1m"] for r in got.collect()] == [None, 500.0, -100.0, None, None, 500.0]


def test_classes(spark):
    df = spark.createDataFrame([(900, 0, 10), (100, 60, 10), (450, 0, 10), (10, 0, 900), (10, 0, 10)], "a int, m int, d int")
    got = [r[0] for r in df.select(E.terrain("a", "m", "d")).collect()]
    assert got == ["MOUNTAIN", "MOUNTAIN", "SEMI-MOUNTAIN", "URBAN", "LOWLAND"]
    bands = spark.createDataFrame([(60.0,), (6.0,), (1.0,), (0.0,)], "p double").select(E.severity_band("p"))
    assert [r[0] for r in bands.collect()] == ["CRITICAL", "WARNING", "OK", "CLEAN"]


def test_rename_only_where_the_target_is_absent(spark):
    df = spark.createDataFrame([("1", "2")], "DEP_CODE string, DEP string")
    assert E.rename_absent(df, {"DEP_CODE": "DEP"}).columns == ["DEP_CODE", "DEP"]
