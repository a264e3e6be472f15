import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from retropanel.llm import queries  # noqa: E402
from tests.llm.test_text_operators import fingerprint, groups, kept_text  # noqa: E402
from tests.llm.test_tokens import fewest, packed  # noqa: E402


def test_stages_equal_their_operators(spark, sf):
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    columns = docs.columns
    toxic = {r["doc_id"] for r in queries.op6_toxicity(spark, sf).filter("predicted = 1").collect()}
    stage = dict(corpus_pipeline.STAGES)

    def step(name, df):
        out = stage[name](spark, df, sf)
        assert out.columns == columns
        rows = out.collect()
        return spark.createDataFrame(rows, out.schema), rows

    clean, rows = step("toxicity", docs)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()} - toxic
    read, rows = step("language_id", clean)
    assert len(rows) >= 0.99 * clean.count()
    before = [(r["doc_id"], r["text"]) for r in rows]
    lined, rows = step("line_dedup", read)
    after = {d: t for d, _, _, t in kept_text(before)}
    assert {r["doc_id"]: r["text"] for r in rows} == after and all(r["n_chars"] == len(r["text"]) for r in rows)
    single, rows = step("near_duplicates", lined)
    prints = [(d, fingerprint(t)) for d, t in after.items()]
    assert {r["doc_id"] for r in rows} == {c for _, _, c in groups(prints)}
    got = stage["packing"](spark, single, sf).collect()
    assert packed(got, [(r["doc_id"], r["text"]) for r in rows], 2048) == fewest([r["length"] for r in got], 2048)
    whole = corpus_pipeline.run(spark, sf).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, got))


def test_stages_take_odd_rows(spark, edge, empty, sf):
    clash = edge.selectExpr("*", "'own' AS predicted", "'own' AS rejected", "'own' AS lang_pred", "'own' AS n_dropped", "'own' AS __num__", "'own' AS __fp__", "'own' AS text2")
    own = [c for c in clash.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    for df, rows in ((clash, 14), (empty, 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, sf)
            got = out.collect()
            assert len(got) > 0 if rows else not got, name
            if name != "packing":
                assert out.columns == df.columns, name
                assert all(r[c] == "clash" or r[c] == "own" for r in got for c in (own if rows else ())), name


def test_one_of_each_group_stays(spark, empty, sf):
    same = "same words in this text"
    odd = spark.createDataFrame([(None, same, "en", "s", 1), (None, same, "en", "s", 1), (3, same, "en", "s", 1), (3, same, "en", "s", 1), (2, "quite another text of some words", "en", "s", 1), (9, None, "en", "s", 1), (8, " ", "en", "s", 1)], empty.schema)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r["doc_id"] for r in stage(spark, odd, sf).collect()) == [2, 3, 8]
    assert [r["doc_id"] for r in stage(spark, odd.filter("doc_id IS NULL"), sf).collect()] == [None]


def test_long_documents_set_the_language_limit(spark, empty, sf):
    """The limit comes from all learned documents, so one in unknown letters goes though all others are long."""
    long = [(i, "der die und schung " * 2000 if i % 2 else "the than and onth " * 2000, "de" if i % 2 else "en", "s", 1) for i in range(16)]
    docs = spark.createDataFrame([*long, (100, "щи борщ каша " * 30, None, "s", 1), (101, "the than and", None, "s", 1)], empty.schema)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, sf).collect()) == [*range(16), 101]
