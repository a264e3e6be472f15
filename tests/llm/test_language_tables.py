import numpy as np
import pytest

from retropanel.llm import language_id, ragged
from tests.llm.test_language_and_toxicity import corpus

SCHEMA = "doc_id bigint, text string, lang string"


def test_every_gram_is_kept(spark):
    """More n-grams than any fixed bound of the past, a small language among them."""
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = [(i, " ".join("".join(rng.choice(letters, 8)) for _ in range(2500)), "xx") for i in range(20)]
    rows += [(100, "seldom spoken words", "yy")]
    kept, _, size = language_id.tables(language_id.gram_counts(spark.createDataFrame(rows, SCHEMA)))
    assert kept[4].filter("lang = 'xx'").count() > 1 << 18
    assert kept[4].filter("lang = 'yy'").count() == 7 + 7 + 6 - 1  # two words begin alike
    assert size == sum(k.count() for k in kept)


def test_models_as_tables_decide_alike(spark, monkeypatch, edge, empty):
    train = spark.createDataFrame(corpus(), SCHEMA)
    arrays = language_id.fit(train)
    monkeypatch.setattr(language_id, "CELLS", 0)
    joined = language_id.fit(train)
    assert isinstance(arrays, language_id.Models) and isinstance(joined, language_id.TableModels)
    assert (joined.langs, joined.alphabet, joined.temperature) == (arrays.langs, arrays.alphabet, arrays.temperature)
    assert joined.worst == pytest.approx(arrays.worst)
    odd = [(1000, None, None), (1001, "12 -- 34", None), (1002, "щи борщ каша " * 30, None), (None, "der die und", None), (None, "the than and", None)]
    df = spark.createDataFrame([*corpus(seed=2), *odd], SCHEMA).repartition(3)
    key = lambda r: (str(r["doc_id"]), r["lang_pred"])
    for docs, rows in ((df, 245), (edge, 14), (empty, 0)):
        a, b = (sorted(language_id.identify(docs, m).collect(), key=key) for m in (arrays, joined))
        assert len(a) == len(b) == rows
        assert [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in a] == [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in b]
        assert [r["score"] for r in a] == pytest.approx([r["score"] for r in b])


@pytest.mark.parametrize("cells", [language_id.CELLS, 0])
def test_all_training_rows_calibrate(spark, monkeypatch, cells):
    """Texts over 32 KiB and more rows than any fixed sample of the past count, whatever their hashes."""
    monkeypatch.setattr(language_id, "CELLS", cells)
    many = [(i, " ".join(t.split()[: 2 + i % 3]), x) for i, t, x in corpus(n=2400)]
    own = [*many, *[(i, "the than and " * 3000 + "zq" * (i % 50), "en") for i in range(5000, 5004)], (6000, "12 34", "en"), (6001, None, "de")]
    train = spark.createDataFrame([*own, (6002, "щи борщ", None)], SCHEMA).repartition(3)
    models = language_id.fit(train)
    monkeypatch.undo()
    arrays = models if cells else language_id.fit(train)
    use = [(t, x) for _, t, x in own if t and t != "12 34"]
    h, n = language_id.Identifier(arrays).entropies(ragged.of_strings([t for t, _ in use]))
    truth = h[np.arange(len(use)), [arrays.langs.index(x) for _, x in use]]
    z = -(h - truth[:, None]) * np.sqrt(n)[:, None]
    loss = [np.log(np.exp(z / t - (z / t).max(1)[:, None]).sum(1)).sum() + (z / t).max(1).sum() for t in language_id.TEMPERATURES]
    assert len(use) == 2404 and models.temperature == language_id.TEMPERATURES[int(np.argmin(loss))]
    assert models.worst == pytest.approx(1.5 * np.quantile(truth, 0.999), rel=1e-9)


def test_long_texts_alone_calibrate(spark):
    long = [(i, "der die und schung " * 2000 if i % 2 else "the than and onth " * 2000, "de" if i % 2 else "en") for i in range(4)]
    models = language_id.fit(spark.createDataFrame(long, SCHEMA))
    assert np.isfinite(models.worst)
    odd = spark.createDataFrame([(1, "щи борщ каша " * 30, None), (2, "the than and", None)], SCHEMA)
    assert {r["doc_id"]: r["rejected"] for r in language_id.identify(odd, models).collect()} == {1: True, 2: False}
