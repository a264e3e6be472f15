import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from retropanel.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def code(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(leaves, arity):
    """(root, siblings before and after each leaf, level by level)."""
    paths, spans, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        up, over = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k in range(len(run)):
                for i in spans[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            over.append([i for s in spans[at : at + arity] for i in s])
        nodes, spans = up, over
    return nodes[0], paths


def brute(rows, tamper=lambda r: r, arity=2):
    """Every output row of rows (dicts), from the definition."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], h(*(code(r[f]) for f in FIELDS)), h(*(code(tamper(r)[f]) for f in FIELDS))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = grow([x[1] for x in groups[g]], arity)
    root, tops = grow([trees[g][0] for g in order], arity) if order else (None, [])
    out = []
    for g, top in zip(order, tops):
        for (doc, leaf, now), path in zip(groups[g], trees[g][1]):
            folded = now
            for before, after in path + top:
                folded = h(before, folded, after)
            out.append((doc, leaf, trees[g][0], root, h(*(a + b for a, b in path + top)), folded, folded == root))
    return sorted(out, key=str)


def tampered(r):
    hit = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
    return {**r, "n_chars": r["n_chars"] + 1} if hit else r


def got(df):
    rows = df.withColumn("proof_sha256", merkle.proof_hash(F.col("path"))) if "path" in df.columns else df
    return sorted((tuple(r) for r in rows.select(*COLUMNS).collect()), key=str)


def test_query_equals_definition(spark, sf, docs):
    rows = [r.asDict() for r in docs.collect()]
    want = brute(rows, tampered)
    assert got(queries.op13_merkle_manifest(spark, sf)) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_odd_rows_and_arities(spark, edge, empty, arity):
    more = spark.createDataFrame([(None, "x", None, None, None), (None, "x", None, None, None), (None, None, "zz", "s", 9223372036854775807), (9, "", "日本", "", 0)], empty.schema)
    docs = edge.unionByName(more, allowMissingColumns=True).selectExpr("*", "'clash' AS idx", "'clash' AS hash", "'clash' AS `group`", "'clash' AS leaf", "'clash' AS path", "'clash' AS now")
    rows = [{f: r[f] for f in FIELDS} for r in docs.collect()]
    assert got(merkle.manifest(docs, arity=arity)) == brute(rows, arity=arity)


def test_a_changed_field_never_folds_to_the_root(spark, edge):
    rows = merkle.manifest(edge, changed={"text": F.concat(F.col("text"), F.lit(" "))}).collect()
    whole = {r["doc_id"]: r["verified"] for r in rows}
    assert whole.pop(0) and not any(whole.values())  # document 0 has no text to change


def test_one_row_and_none(spark, empty):
    one = spark.createDataFrame([(7, "x", "en", "s", 1)], empty.schema)
    assert got(merkle.manifest(one)) == brute([r.asDict() for r in one.collect()])
    assert merkle.manifest(empty).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(one, arity=1)


def test_numbers_span_partitions(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 10 < 7 THEN 'a' ELSE cast(id % 4 AS string) END AS g", "id DIV 3 AS k", "cast(id AS string) AS hash").repartition(9)
    placed = merkle.numbered(rows, ["g"], ["k", "hash"]).collect()
    by = {}
    for r in placed:
        by.setdefault(r["g"], []).append((r["k"], r["hash"], r["idx"], r["n"]))
    for found in by.values():
        found.sort()
        assert [x[2] for x in found] == list(range(len(found))) and {x[3] for x in found} == {len(found)}
