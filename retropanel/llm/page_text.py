"""Main text of web pages by a linear-chain conditional random field over leaf blocks (operator 12).

A page is a chain of leaf blocks (see ``dom``) with features of the ancestors' tags and names, of the text and
of the place in the page. The field learns which blocks are main text and how the label goes on from block to
block, apart for neighbours under one element and others; Viterbi finds the likeliest labels of a page.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel.llm import crf, dom
from retropanel.llm.common import bounded_batches, fields, release
from retropanel.llm.page_layouts import MARK, Writer

SAMPLE = 400
SAMPLE_BYTES = 1 << 16
LAYOUTS = 1500
#: Elements that say what the main text is, and those inside them that are not part of it.
MAIN = ("article", "main")
NOT_MAIN = frozenset("nav aside form footer menu dialog".split())
BLOCKS_AT_ONCE = 20_000

Page = list[dom.Block]


def kinds_of(page: Page) -> list[int]:
    """Which moves lead to each block: 1 from a neighbour under the same parent element, else 0."""
    out = [0]
    for a, b in zip(page, page[1:]):
        out.append(int(a.place is b.place or (a.place.parent is not None and a.place.parent is b.place.parent)))
    return out[: len(page)]


def marked(page: str) -> tuple[Page, list[int]]:
    """Blocks and labels of a page whose main text is marked."""
    found = dom.blocks(page)
    return [b._replace(text=b.text.replace(MARK, "") or "-") for b in found], [int(MARK in b.text) for b in found]


def declared(page: str) -> tuple[Page, list[int]] | None:
    """Blocks and labels of a page that names its main text by an element; None for others."""
    found = dom.blocks(page)
    for tag in MAIN:
        labels = [int(tag in b.place.tags and not b.place.tags & NOT_MAIN) for b in found]
        if any(labels):
            return found, labels
    return None


def chains(pages: Sequence[Page]) -> crf.Chains:
    codes = [[*b.place.codes, *dom.text_codes(b, i, len(page))] for page in pages for i, b in enumerate(page)]
    at = np.concatenate([[0], np.cumsum([len(c) for c in codes], dtype=np.int64)]).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pages], dtype=np.int64)]).astype(np.int64)
    return crf.Chains(bounds, np.fromiter((c for step in codes for c in step), np.int64, int(at[-1])), at, np.array([k for p in pages for k in kinds_of(p)], np.int64))


def fit_pages(pages: Sequence[str], layouts: int = LAYOUTS, seed: int = 12) -> crf.Model:
    """A field trained on the pages that declare their main text and on so many generated layouts, whose words
    are those of the pages."""
    known = [k for k in map(declared, pages) if k]
    words = sorted({w for page, _ in known for b in page for w in b.text.split(" ")[:200]})
    writer = Writer(words, seed)
    known += [marked(writer.page()) for _ in range(layouts)]
    known = [(page, labels) for page, labels in known if page]
    return crf.train(chains([p for p, _ in known]), np.array([y for _, labels in known for y in labels], np.int64), 1 << dom.FEATURE_BITS, 2)


def fit(pages: DataFrame, sample: int = SAMPLE, page_id: str = "page_id", html: str = "html", layouts: int = LAYOUTS) -> crf.Model:
    """Train on ``sample`` pages of up to 64 KiB, those with the smallest hash of their id and text, and on
    generated layouts. The hashes are compared before any page reaches the driver."""
    short = pages.select(F.col(f"`{html}`").cast("string").alias("html"), F.xxhash64(F.col(f"`{page_id}`").cast("string"), F.col(f"`{html}`").cast("string")).alias("h")).filter(F.octet_length("html") <= SAMPLE_BYTES)
    limits = [r["h"] for r in short.select("h").orderBy("h").limit(sample).collect()]
    chosen = short.filter(F.col("h") <= (limits[-1] if limits else 0)).orderBy("h", "html").limit(sample).collect()
    return fit_pages([r["html"] for r in chosen], layouts)


class Extractor:
    """Texts of many pages by a trained field."""

    def __init__(self, model: crf.Model) -> None:
        self.model, self.weights = model, model.weights.tolist()

    def scores(self, page: Page) -> list[float]:
        weights, seen, out = self.weights, {}, []
        for i, b in enumerate(page):
            base = seen.get(id(b.place))
            if base is None:
                base = seen[id(b.place)] = sum(weights[c] for c in b.place.codes)
            out.append(base + sum(weights[c] for c in dom.text_codes(b, i, len(page))))
        return out

    def texts(self, pages: list[str | None]) -> Iterator[str]:
        """The main text of each page, some pages at a time."""
        held: list[list[str]] = []
        score: list[float] = []
        kinds: list[int] = []

        def flush() -> Iterator[str]:
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in held], dtype=np.int64)]).astype(np.int64)
            labels = crf.viterbi(np.array(score), np.array(kinds, np.int64), bounds, self.model)
            for i, page in enumerate(held):
                own = labels[bounds[i] : bounds[i + 1]]
                yield "\n".join(text for text, y in zip(page, own.tolist()) if y)

        for page in pages:
            found = dom.blocks(page or "")
            score.extend(self.scores(found))
            kinds.extend(kinds_of(found))
            held.append([b.text for b in found])
            if len(score) >= BLOCKS_AT_ONCE:
                yield from flush()
                held, score, kinds = [], [], []
        yield from flush()


def extract(pages: DataFrame, model: crf.Model, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Kept columns with ``text`` (main blocks in page order, one newline between) and ``n_chars``.

    One narrow pass over whole pages, no shuffle. A null or empty page, or one without main text, has an
    empty text; repeated rows give a row each; an empty table gives an empty result; a kept column named like
    a new one gives way to it, other columns take no part.
    """
    keep = [c for c in keep if c not in ("text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model)  # 2^16 weights, whatever the pages
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").cast("string").alias("__html__"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        reader = Extractor(shared.value)
        for batch in batches:
            texts = [t.encode("utf-8", "replace").decode("utf-8") for t in reader.texts(batch.column(len(keep)).to_pylist())]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], [*keep, "text", "n_chars"])

    return bounded_batches(rows).mapInArrow(run, T.StructType([*rows.schema.fields[: len(keep)], *fields(text="string", n_chars="bigint").fields]))
