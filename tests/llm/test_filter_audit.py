import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from retropanel.llm import filter_audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = [(1, 1, 0), (1, 0, 1), (5, 1, 0), (6, 1, 1), (9, 0, 1), (9, None, None), (None, 1, 1), (77, 1, 1)]


def brute(docs, labels):
    """All rows by running every order over every document."""
    least = {}
    for d, _, t in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, part, t in docs:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and least[t] < d}
        fails.append((d, part or "", f))
    out = {}
    removed_by = Counter()
    for part in {p for _, p, _ in fails}:
        mine = [(d, f) for d, p, f in fails if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[letter]]
                left = [(d, f) for d, f in left if not f[letter]]
                early = sum(f[letter] for _, f in mine) - len(gone)
                only = sum(f[letter] and sum(f.values()) == 1 for _, f in mine)
                out[part, order, step] = [len(left), len(gone), early, only, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                removed_by[part, letter] += len(gone)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows(df):
    found = [tuple(r) for r in df.collect()]
    out = {r[:3]: r[3:] for r in found}
    assert len(out) == len(found)
    return out


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").selectExpr("*", "'clash' AS good", "'clash' AS mask", "'clash' AS part")


def test_odd_rows(spark, edge, labels):
    more = spark.createDataFrame([(None, "two words", "de", None, 1), (None, "two words", "de", "s4", 1), (13, None, "de", None, 1), (13, "A B", "de", "s4", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = edge.select(*more.columns).unionByName(more)
    want = brute([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()], LABELS)
    wide = edge.selectExpr("doc_id", "text", "source", "'x' AS part", "'x' AS mask", "'x' AS `key`", "'x' AS first")
    wide = wide.unionByName(more.selectExpr("doc_id", "text", "source", "'x' AS part", "'x' AS mask", "'x' AS `key`", "'x' AS first"))
    assert rows(filter_audit.audit(filter_audit.tensors(filter_audit.failures(wide), labels))) == want


def test_query_equals_running_every_order(spark, sf, docs):
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    got = rows(queries.op11_filter_audit(spark, sf))
    assert got == brute([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()], marks)
    parts = defaultdict(set)
    for part, order, step in got:
        parts[part].add((order, step))
    assert all(len(x) == 600 for x in parts.values())


def test_empty_tables(spark, empty, labels, edge):
    assert filter_audit.audit(filter_audit.tensors(filter_audit.failures(empty), labels)).count() == 0
    none = filter_audit.tensors(filter_audit.failures(edge), labels.limit(0))
    assert all(v[4:6] == (0, 0) for v in rows(filter_audit.audit(none)).values())


def test_contractions_are_sums_of_cells():
    counts = np.arange(32).reshape(2, 2, 2, 2, 2)
    got = filter_audit.contract(counts, filter_audit.selectors("removed"))
    cell = lambda mask: [(mask >> (4 - i)) & 1 for i in range(5)]
    for k, (order, step) in enumerate((o, s) for o in filter_audit.ORDERS for s in range(5)):
        own, before = "ABCDE".index(order[step]), ["ABCDE".index(f) for f in order[:step]]
        assert got[k] == sum(m for m in range(32) if cell(m)[own] and not any(cell(m)[b] for b in before))
