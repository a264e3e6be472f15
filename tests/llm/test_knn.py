import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retropanel.llm import exact_knn, queries


def brute(rows, asked, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1 << 18 for x in v):
            good.setdefault((i, tuple(math.floor(256 * float(np.float32(x))) for x in v)), None)
    out, pairs = [], {}
    for q, a in good:
        if q % asked == 0:
            pairs.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(b) == len(a))
    for q, scored in pairs.items():
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, asked, k=5):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("v", F.lit(1))
    return sorted(map(tuple, exact_knn.top_k(df.repartition(3), F.col("vec_id") % asked == 0, k).collect()))


@pytest.mark.parametrize("block", [7, 2048])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(exact_knn, "CELL_BLOCK", block)
    monkeypatch.setattr(exact_knn, "QUERY_BLOCK", 3)
    monkeypatch.setattr(exact_knn, "SALT_BLOCKS", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 9)]) for i in range(120)]
    rows += [(200 + i, rows[10][1]) for i in range(30)]  # copies beyond k, queries among them
    rows += [(300, None), (301, [0.1, None] + [0.0] * 7), (302, [float("nan")] * 9), (303, [float("inf")] * 9), (None, rows[0][1]), (304, [])]
    rows += [(10, rows[10][1]), (20, [0.0] * 9), (40, [0.5, 0.25]), (45, [0.5, 0.75]), (305, [-1.0, 0.5])]
    assert run(spark, rows, 5) == brute(rows, 5, 5)


def test_ids_with_many_vectors(spark):
    """More own vectors than results, copies of them under other ids, and components out of range."""
    rng = np.random.default_rng(8)
    rows = [(50, [1.0 + i / 8, 1.0, 0.5]) for i in range(20)] + [(i, [float(x) for x in rng.normal(0, 0.2, 3)]) for i in range(1, 10)]
    rows += [(3, [2.0, 1.0, 0.5]), (100, [2.0, 1.0, 0.5]), (100, [0.5, 0.5, 0.5]), (150, [1e18, 1.0, 1.0]), (7, [0.1, -262144.0, 0.0]), (8, [262143.0, 0.5, 0.0])]
    got = run(spark, rows, 50)
    assert got == brute(rows, 50, 5) and {r[0]: r[1] for r in got} == {50: 5, 100: 5}


def test_few_rows_and_none(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(5, [1.0, 2.0])], 5) == []
    rows = [(5, [1.0, 2.0]), (6, [1.0, -2.0]), (7, [0.5, 0.5])]
    assert run(spark, rows, 5) == brute(rows, 5, 5)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    v, q = rng.integers(-200, 200, (500, 11)), rng.integers(-200, 200, (20, 11)).astype(float)
    borders = np.maximum.accumulate(np.concatenate([v.min(0)[:, None], np.quantile(v, np.arange(1, 64) / 64, axis=0).T.round(), v.max(0)[:, None] + 1], 1), axis=1)
    low, high = exact_knn.bounds(q, exact_knn.to_cells(v, borders), borders)
    exact = q @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high - low).mean() < np.ptp(exact) / 8


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, queries.op1_exact_top_k(spark, sf).collect())) == brute(rows, 50, 5)
