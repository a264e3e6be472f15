import numpy as np

from retropanel.llm import token_files
from retropanel.llm.queries import tokenizer
from retropanel.session import scratch_path


def test_rows_without_doc_id_are_coded(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 8)
    rows = [(None, "first of those without a number"), (None, None), (0, "zero"), (-5, "below zero"), (None, "another one"), (3, "three words here")]
    path = scratch_path(spark, "nameless")
    token_files.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), tokenizer("byte_bpe_50k.json"), path)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, None, -5, 0, 3]
    named = scratch_path(spark, "named")
    token_files.write(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id bigint, text string"), tokenizer("byte_bpe_50k.json"), named)
    want = sorted(bytes(r["ids"]) for r in token_files.read(spark, named).collect())
    assert sorted(bytes(r["ids"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
