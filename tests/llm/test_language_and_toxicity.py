import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from retropanel.llm import language_id, queries, ragged, toxicity

LANGS = {"en": "the than and of in onth reing eron shwh hath", "de": "der die und schung ßach einkeit überge zu", "fr": "le la des équeux aille oitre réè ment"}


def corpus(seed=1, n=240):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        lang = list(LANGS)[i % 3]
        parts = LANGS[lang].split()
        rows.append((i, " ".join("".join(rng.choice(parts, 2)) for _ in range(int(rng.integers(3, 40)))), lang))
    return rows


def brute_models(rows):
    """Interpolated Kneser-Ney from dictionaries: (lang, order) -> n-gram -> count."""
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        word = ""
        for c in text.lower() + " ":
            if c.isalpha():
                word += c
                continue
            if word:
                padded = " " * 4 + word + " "
                counts[lang, 5].update(padded[i : i + 5] for i in range(len(padded) - 4))
            word = ""
    for lang in {x for x, _ in list(counts)}:
        for order in range(4, 0, -1):
            counts[lang, order] = Counter(g[1:] for g in counts[lang, order + 1])
    return counts


def brute_log(counts, lang, gram, alphabet):
    p = 1 / alphabet
    for order in range(1, 6):
        c, g = counts[lang, order], gram[5 - order :]
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        less = once / (once + 2 * twice) if once else 0.5
        own = {k: v for k, v in c.items() if k[:-1] == g[:-1]}
        total = sum(own.values())
        if total:
            given = sum(max(v - less, 0) for v in own.values()) / total
            p = max(c[g] - less, 0) / total + min(max(1 - given, 1e-6), 1) * p
    return math.log(p)


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus()
    return rows, language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_probabilities_equal_the_definition(trained):
    rows, models = trained
    counts = brute_models(rows)
    grams = ["    t", " theh", "eing ", "ßachü", "xyzqq", "oille", "   un"]
    points = language_id._columns(grams, 5)
    got = language_id.log_shares(models, points)
    for k, lang in enumerate(models.langs):
        assert got[:, k] == pytest.approx([brute_log(counts, lang, g, models.alphabet) for g in grams])


def test_events_follow_words():
    columns, bounds = language_id.events(ragged.of_strings(["Ab, c", "", "1 2", "É"]))
    grams = ["".join(chr(c[i]) for c in reversed(columns)) for i in range(len(columns[0]))]
    assert grams == ["    a", "   ab", "  ab ", "    c", "   c ", "    é", "   é "]
    assert bounds.tolist() == [0, 5, 5, 5, 7]


def test_languages_and_rejection(spark, trained, edge, empty):
    _, models = trained
    fresh = [(i, t, x) for i, t, x in corpus(seed=2)]
    df = spark.createDataFrame([*fresh, (1000, None, None), (1001, "12 -- 34", None), (1002, "щи борщ каша " * 30, None)], "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(df, models).collect()}
    assert np.mean([got[i]["lang_pred"] == x for i, _, x in fresh]) > 0.98
    assert np.mean([got[i]["rejected"] for i, _, _ in fresh]) < 0.01
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (1000, 1001)] == ["und", "und"]
    assert got[1002]["rejected"] and got[1002]["lang_pred"] in models.langs
    assert language_id.identify(edge, models).count() == 14
    assert language_id.identify(empty, models).count() == 0
    nothing = language_id.fit(empty)
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}


def test_language_query(spark, sf):
    got = queries.op2_language_id(spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean(held) > 0.9


def toxic_corpus(seed, n=900):
    rng, rows = np.random.default_rng(seed), []
    bad = ["worthless", "pathetic", "disgusting", "stupid"]
    for i in range(n):
        words = ["".join(rng.choice(list("aeioustrnlm"), int(rng.integers(2, 8)))) for _ in range(int(rng.integers(5, 300)))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 60):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad)))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_learns_words_and_their_misspellings(spark, edge, empty):
    rows = toxic_corpus(1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, sample=400)
    fresh = toxic_corpus(2, 300)
    score = toxicity.Scorer(model)
    p = score(ragged.of_strings([r[1] for r in fresh]))
    truth = np.array([r[2] for r in fresh])
    assert (p[truth == 1] >= 0.5).mean() > 0.8 and (p[truth == 0] < 0.5).mean() > 0.95
    clean = " ".join(r[1] for r in fresh if not r[2])
    long = score(ragged.of_strings([clean[:2000], clean[:2000] + " worthlesss patethic disgustingg stupiid"]))
    assert long[0] < 0.5 < long[1]
    got = toxicity.toxicity_scores(edge, model).collect()
    assert len(got) == 14 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1, 2)}) == 1
    assert toxicity.toxicity_scores(empty, model).count() == 0
    unlearned = toxicity.fit(empty, labels)
    assert {r["predicted"] for r in toxicity.toxicity_scores(edge, unlearned).collect()} == {0}


def plain_score(model, text):
    """The score from its definition, one word and one window at a time."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    words = [w for i, w in enumerate(words) if i == 0 or words[i - 1] != w]

    def value(word):
        points = [32, *(ord(c.lower() if len(c.lower()) == 1 else c) for c in word.decode()), 32]
        keys = []
        for n in (3, 4, 5):
            for i in range(len(points) - n + 1):
                h = n + sum(p * int(m) for p, m in zip(points[i : i + n], toxicity._MULTIPLIERS))
                keys.append(int(ragged.mix(np.array([h % (1 << 64)], np.uint64))[0]))
        keys.append(int(ragged.hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]))
        return np.mean([float(model.bucket[k % toxicity.BUCKETS]) for k in keys])

    values = [value(w) for w in words]
    starts = sorted({*range(0, max(len(words) - 16, 0), 8), max(len(words) - 16, 0)})
    top = max(sum(values[a : a + 16]) / 16 for a in starts) if words else 0.0
    return 1 / (1 + math.exp(-(top + model.bias)))


def test_scores_follow_their_definition(spark, edge):
    rows = toxic_corpus(3, 400)
    model = toxicity.train(ragged.of_strings([r[1] for r in rows]), np.array([r[2] for r in rows]), epochs=3)
    texts = [r[1] for r in toxic_corpus(4, 60)] + [r["text"] for r in edge.collect() if len(r["text"] or "") < 6000] + ["Word word WORD other", "été ÉTÉ 日本 a"]
    got = toxicity.Scorer(model)(ragged.of_strings(texts))
    assert got == pytest.approx([plain_score(model, t) for t in texts], abs=1e-6)


def test_held_out_toxicity(spark):
    """Documents whose labels the query never sees."""
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(toxic[r["doc_id"]], r["predicted"], r["score"]) for r in queries.op6_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in toxic]
    bad, clean = [p for t, p, _ in held if t == 1], [p for t, p, _ in held if t == 0]
    assert len(bad) > 50 and np.mean(bad) >= 0.7 and np.mean(clean) <= 0.03
    assert np.mean([s for t, _, s in held if t == 1]) > 0.5 + np.mean([s for t, _, s in held if t == 0])


def test_sample_ignores_held_out_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, None), (4, "x" * 40_000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 1)], "doc_id bigint, toxic int")
    rows, classes = toxicity.labelled_sample(docs, labels, "text", "doc_id", "toxic", 10)
    assert [rows.row(i).decode() for i in range(len(classes))] == ["a", "c"] and classes.tolist() == [1, 0]


def test_toxicity_query(spark, sf):
    got = queries.op6_toxicity(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
