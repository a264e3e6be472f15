import html
import re
from itertools import product

import numpy as np
import pytest

from retropanel.llm import crf, dom, page_text, queries
from retropanel.llm.page_layouts import Writer


def article(page):
    """The text of a page of the given tables, by their fixed layout."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark, sf):
    return page_text.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def test_query_finds_the_articles(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op12_page_text(spark, sf).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_unseen_layouts(model):
    writer, whole, right, steps = Writer("one two three four five six seven".split(), 4711), 0, 0, 0
    for _ in range(400):
        page, labels = page_text.marked(writer.page())
        chain = page_text.chains([page])
        found = crf.viterbi(crf.scores(model.weights, chain), chain.kinds, chain.bounds, model).tolist()
        whole += found == labels
        right, steps = right + sum(a == b for a, b in zip(found, labels)), steps + len(labels)
    assert right / steps > 0.99 and whole / 400 > 0.9


PAGE = """<!doctype html><html><head><title>not shown</title><script>if (a < b) document.write("<p>x</p>")</script></head>
<body class="single"><header class="site-header"><a href="/">Home</a></header><ul class="nav"><li><a href="/a">One</a><li><a href="/b">Two</a></ul>
<div class="cookie-notice">We use cookies to improve this site. <button>Accept all</button></div>
<div class="post-body"><h1>Caf&eacute; &amp; more</h1><p>First   paragraph with <b>bold <i>text</b></i> and a<br>break.<p>Second one, &lt;b&gt; is no markup.
<div class="ad">Buy now</div><ul><li>item one<li>item two</ul><!-- <p>hidden</p> --><form class="search"><label>Find</label><input></form></div>
<section class="comments"><div class="comment"><p>I liked this a lot.</p></div></section><footer>&copy; example.com</footer>"""


def test_a_page_with_everything(model):
    assert list(page_text.Extractor(model).texts([PAGE])) == ["Café & more\nFirst paragraph with bold text and a break.\nSecond one, <b> is no markup.\nitem one\nitem two"]


def blocks(page):
    return [b.text for b in dom.blocks(page)]


def test_malformed_markup():
    assert blocks("") == blocks("<p></p>") == blocks("<!-- never closed <p>a</p>") == blocks("<script>a</p>") == []
    assert blocks("a<p>b<p>c</div>d</p>e") == ["a", "b", "c", "d", "e"]
    assert blocks("1 < 2 and 3 > 2") == ["1 < 2 and 3 > 2"]
    assert blocks("<p title='a>b' class=\"x>y\">in</p><p title=\"open>out") == ["in", "out"]
    assert blocks("<p>cut in a tag <di") == ["cut in a tag"]
    assert blocks("<h2>a</h3>b") == ["a", "b"]
    assert blocks("<SCRIPT>x</ScRiPt ><P>y&nbsp;&nbsp; z&#x41;&unknown;</P>") == ["y zA&unknown;"]
    assert blocks("<svg><text>no</text></svg>yes<template><p>no</p></template>") == ["yes"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000 + "</p>" * 20_000 + "<b>" * 20_000 + '"' * 20_000
    assert blocks(deep)[0] == "x"


def test_links_and_places():
    a, b, c = dom.blocks('<nav><a href=x>one</a></nav><p>two <a href="y">three</a></p><p>four')
    assert (a.linked, b.linked, c.linked) == (3, 5, 0) and a.place.tags == {"nav"}
    again = dom.blocks("<div class='mainMenu big-box' id=Top><p>x</p><p>y</p></div>")
    assert again[0].place is again[1].place and again[0].place.parent.names == {"main", "menu", "big", "box", "top"}


def every(score, kinds, model):
    """All label sequences with their scores."""
    for y in product((0, 1), repeat=len(score)):
        s = model.begin[y[0]] + sum(score[t] * y[t] for t in range(len(y))) + sum(model.moves[kinds[t]][y[t - 1]][y[t]] for t in range(1, len(y)))
        yield y, s


def test_field_against_enumeration():
    rng = np.random.default_rng(3)
    model = crf.Model(rng.normal(size=8), rng.normal(size=(2, 2, 2)), rng.normal(size=2))
    bounds = np.array([0, 4, 4, 5, 11])
    score, kinds = rng.normal(size=11), rng.integers(2, size=11)
    labels = crf.viterbi(score, kinds, bounds, model)
    one, moves, begin, total = crf.expectations(score, kinds, bounds, model)
    logs, seen, starts = 0.0, np.zeros((2, 2, 2)), np.zeros(2)
    for a, b in zip(bounds, bounds[1:]):
        if a == b:
            continue
        found = list(every(score[a:b], kinds[a:b], model))
        assert tuple(labels[a:b]) == max(found, key=lambda x: x[1])[0]
        weight = np.exp([s for _, s in found])
        logs += np.log(weight.sum())
        for (y, _), p in zip(found, weight / weight.sum()):
            starts[y[0]] += p
            for t in range(1, b - a):
                seen[kinds[a + t]][y[t - 1]][y[t]] += p
        assert np.allclose(one[a:b], sum(p * np.array(y) for (y, _), p in zip(found, weight / weight.sum())))
    assert np.isclose(total, logs) and np.allclose(moves, seen) and np.allclose(begin, starts)


def test_odd_rows(spark, sf, model):
    rows = [(1, "u", None), (2, "v", ""), (None, None, "<article><p>same</p></article>"), (None, None, "<article><p>same</p></article>"), (4, "w", "<article><p>" + "word " * 400_000 + "</p></article>"), (5, "x", "no markup \ud83d at all".encode("utf-8", "replace").decode())]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'clash' AS text", "'clash' AS n_chars", "'clash' AS __html__")
    got = sorted(page_text.extract(df, model).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    assert [r["text"] for r in got[:2]] == ["", ""] and [r["text"] for r in got[4:]] == ["same", "same"]
    assert got[2]["n_chars"] == 5 * 400_000 - 1 and len(got) == 6
    assert [r["text"] for r in page_text.extract(df, page_text.fit(df.limit(0), layouts=50)).collect() if r["page_id"] == 2] == [""]
    assert page_text.extract(df.limit(0), model).count() == 0
