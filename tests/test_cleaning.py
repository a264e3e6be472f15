import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from retropanel.operators import cleaning as C
from retropanel.operators import dedup as D
from retropanel.operators import gaps as G
from retropanel.sources.dimensions import departments_for_scope

CERT = "numero_dpe string, batch int, date_etablissement_dpe string, code_departement_ban string, etiquette_dpe string, type_generateur_chauffage_principal string, type_generateur_froid string, surface_habitable_logement double"


def certificates(spark):
    good = ("2022-05-10", "69", "C", "Chaudiere gaz", None, 70.0)
    rows = [
        ("ok", 1, *good),
        ("dup", 1, "2022-05-10", "69", "C", "Chaudiere gaz", None, 70.0),
        ("dup", 2, "2022-05-11", "69", "B", "installation PAC  ", "", 80.0),
        ("baddate", 1, "2022-13-40", "69", "C", None, None, 70.0),
        ("early", 1, "2021-06-30", "69", "C", None, None, 70.0),
        ("future", 1, "2030-01-01", "69", "C", None, None, 70.0),
        ("nalabel", 1, "2022-05-10", "69", "N/A", None, None, 70.0),
        ("nolabel", 1, "2022-05-10", "69", None, None, None, 70.0),
        ("pad", 1, "2022-05-10", "1", "A", "PAC air/eau", "PAC reversible", 2.0),
        ("corsica", 1, "2022-05-10", "2A", "G", None, "Climatisation", 5000.0),
        ("nodept", 1, "2022-05-10", "99", "C", None, None, 70.0),
    ]
    return spark.createDataFrame(rows, CERT)


def clean(df, skip=frozenset()):
    return C.clean_certificates(df, ["batch"], departments_for_scope("FR"), "2021-07-01", "2026-02-28", skip)


def test_certificates(spark):
    out = {r["numero_dpe"]: r for r in clean(certificates(spark)).collect()}
    assert set(out) == {"ok", "dup", "pad", "corsica"}
    assert out["dup"]["etiquette_dpe"] == "B" and out["dup"]["is_pac"] == 1 and out["dup"]["is_classe_ab"] == 1
    assert out["dup"]["type_generateur_chauffage_principal"] == "installation PAC" and out["dup"]["is_clim"] == 0
    assert out["pad"]["code_departement_ban"] == "01" and out["pad"]["surface_habitable_logement"] == 5.0
    assert out["corsica"]["surface_habitable_logement"] == 1000.0 and out["corsica"]["is_clim"] == 1
    assert out["ok"]["date_id"] == 202205


def test_skip_rules(spark):
    kept = {r[0] for r in clean(certificates(spark), {"filter_invalid_labels", "filter_invalid_depts"}).select("numero_dpe").collect()}
    assert {"nalabel", "nolabel", "nodept"} <= kept and "early" not in kept


def test_preview_matches_the_rules(spark):
    df = certificates(spark)
    source = C.certificate_source(df, ["batch"], departments_for_scope("FR"), "2021-07-01", "2026-02-28")
    got = {r["rule"]: r["rows_affected"] for r in C.preview(df, source).collect()}
    assert got == {"remove_duplicates": 1, "filter_invalid_dates": 3, "filter_invalid_labels": 2, "clip_outliers": 2, "filter_invalid_depts": 1}


def test_stats_add_up(spark):
    df = certificates(spark)
    s = C.certificate_stats(df, ["batch"], departments_for_scope("FR"), "2021-07-01", "2026-02-28").first()
    assert s["rows_in"] == 11 and s["rows_out"] == 4
    removed = s["duplicates_removed"] + s["date_invalid_removed"] + s["label_invalid_removed"] + s["dept_invalid_removed"]
    assert s["rows_in"] - removed == s["rows_out"]


def weather(spark, rows):
    return spark.createDataFrame(
        rows, "time string, dept string, temperature_2m_max double, temperature_2m_min double, temperature_2m_mean double, precipitation_sum double, n int"
    )


def test_weather(spark):
    rows = [("2023-01-01", "1", 60.0, -40.0, 60.0, -10.0, 1), ("2023-01-01", "1", 9.0, 1.0, 5.0, 2.0, 2), ("2023-01-02", "1", None, None, None, 1.0, 3), ("bad", "1", 1.0, 1.0, 1.0, 1.0, 4), ("2023-01-03", "1", 60.0, -40.0, 60.0, -10.0, 5)]
    out = {str(r["time"]): r for r in C.clean_weather(weather(spark, rows), ["n"]).collect()}
    assert set(out) == {"2023-01-01", "2023-01-03"}
    assert out["2023-01-01"]["hdd"] == 13.0 and out["2023-01-01"]["cdd"] == 0.0 and out["2023-01-01"]["dept"] == "01"
    hot = out["2023-01-03"]
    assert (hot["temperature_2m_max"], hot["temperature_2m_min"], hot["temperature_2m_mean"], hot["precipitation_sum"]) == (50.0, -30.0, 50.0, 0.0)


def test_series_filter_and_fill(spark):
    rows = [("2023-01", 95.0), ("2023-02", None), ("2023Q1", 1.0), ("2023-03", None), ("2023-04", 98.0)]
    df = spark.createDataFrame([(p, v, i) for i, (p, v) in enumerate(rows)], "period string, confiance_menages double, n int")
    out = C.clean_series(df, ["n"]).orderBy("date_id").collect()
    assert [r["confiance_menages"] for r in out] == [95.0, 96.0, 97.0, 98.0]


def fill(spark, values, limit=3):
    df = spark.createDataFrame([("s", i, None if v is None else float(v)) for i, v in enumerate(values)], "s string, i int, v double")
    return [r["v"] for r in G.interpolate(df, "v", ["s"], "i", limit).orderBy("i").collect()]


def test_interpolation_probe(spark):
    n = None
    assert fill(spark, [n, 1, n, n, n, n, n, 7, n, n, n, n]) == [n, 1, 2, 3, 4, n, n, 7, 7, 7, 7, n]


def test_interpolation_matches_pandas(spark):
    rng = np.random.default_rng(7)
    frames = []
    for s in range(40):
        v = rng.normal(0, 10, 20).round(1)
        v[rng.random(20) < 0.5] = np.nan
        frames.append(pd.DataFrame({"s": str(s), "i": range(20), "v": v}))
    pdf = pd.concat(frames)
    want = pdf.groupby("s")["v"].transform(lambda x: x.interpolate("linear", limit=3))
    schema = "s string, i int, v double"
    df = spark.createDataFrame([(a, int(b), None if np.isnan(c) else float(c)) for a, b, c in pdf.itertuples(index=False)], schema)
    got = G.interpolate(df, "v", ["s"], "i").toPandas().sort_values(["s", "i"])["v"].to_numpy(dtype=float)
    expected = pdf.assign(w=want).sort_values(["s", "i"])["w"].to_numpy()
    np.testing.assert_allclose(got, expected, atol=1e-9)


def test_keep_last_with_a_hot_key(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("n"))
    rest = spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 100).alias("k"), F.col("id").alias("n"))
    out = {r["k"]: r["n"] for r in D.keep_last(hot.unionByName(rest), ["k"], ["n"]).collect()}
    assert out["hot"] == 2999 and out["k7"] == 207 and len(out) == 101


def test_keep_last_treats_null_keys_as_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, n int")
    assert sorted((r["k"] or "", r["n"]) for r in D.keep_last(df, ["k"], ["n"]).collect()) == [("", 2), ("a", 1)]


def test_breaks_and_fills(spark):
    df = spark.createDataFrame([("C28", i, v) for i, v in enumerate([100.0, 120.0, 60.0, 61.0])], "c string, i int, v double")
    assert [r["i"] for r in G.series_breaks(df, "v", ["c"], "i").collect()] == [2]
    gappy = spark.createDataFrame([("a", 0, None), ("a", 1, 4.0), ("a", 2, None), ("b", 0, None)], "c string, i int, v double")
    got = {(r["c"], r["i"]): r["v"] for r in G.fill_both_ways(gappy, "v", ["c"], "i", F.lit(9.0)).collect()}
    assert got == {("a", 0): 4.0, ("a", 1): 4.0, ("a", 2): 4.0, ("b", 0): 9.0}


def test_encoding_is_decided_by_file_and_whole_content(spark, tmp_path):
    from retropanel.sources.readers import read_csv_any, sniff_csv

    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes("DEP;LIB;N\n01;Créteil;3\n".encode("latin-1"))
    (folder / "b.csv").write_bytes("DEP;LIB;N\n02;Évry œ;4\n".encode("utf-8"))
    (folder / "c.csv").write_bytes(b"DEP,LIB,N\n03,plain,5\n")
    kinds = {r["file"][-5:]: (r["sep"], r["encoding"]) for r in sniff_csv(spark, str(folder)).collect()}
    assert kinds == {"a.csv": (";", "ISO-8859-1"), "b.csv": (";", "UTF-8"), "c.csv": (",", "UTF-8")}
    got = sorted(map(tuple, read_csv_any(spark, str(folder), ["DEP", "LIB", "N"]).collect()))
    assert got == [("01", "Créteil", "3"), ("02", "Évry œ", "4"), ("03", "plain", "5")]
