"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy (operator 6).

A word's vector is the mean of the vectors of its character n-grams and of itself (hashed), so a misspelling
shares most of it. A bag of words is averaged and goes through a linear softmax. So that a few toxic words
stand out of a long text, bags are windows of words, and a text is as toxic as its most toxic window.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel.llm import ragged
from retropanel.llm.common import fields, with_text_columns, worker_object
from retropanel.llm.letters import code_points

BUCKETS = 1 << 17
DIM = 16
GRAMS = (3, 4, 5)
WINDOW, STRIDE = 16, 8
SAMPLE = 2000
LONGEST = 1 << 15
PER_STEP = 20_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)

#: Words are runs of ASCII letters and digits and of everything beyond ASCII.
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Model(NamedTuple):
    """What scoring needs: each bucket's vector times the softmax weights (class 1 less class 0), and the bias."""

    bucket: np.ndarray
    bias: float


def word_ranges(rows: ragged.Texts) -> tuple[ragged.Texts, ragged.Words, np.ndarray]:
    """Lower-case rows, their words and the words' hashes; a word said many times in a row counts once."""
    rows = ragged.Texts(ragged.lowered(rows.data), rows.offsets)
    found = ragged.words(rows, _GAPS)
    h = ragged.hashes(rows.data, found.starts, found.ends)
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    fresh[found.bounds[:-1][found.bounds[:-1] < len(h)]] = True
    before = np.concatenate([[0], np.cumsum(fresh)])
    return rows, ragged.Words(found.starts[fresh], found.ends[fresh], before[found.bounds]), h[fresh]


def subwords(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word (borders count as spaces) and of the whole word: (buckets, bounds)."""
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    if len(starts) > PER_STEP:  # the steps' arrays are many times their result
        parts = [subwords(rows, starts[a : a + PER_STEP], ends[a : a + PER_STEP]) for a in range(0, len(starts), PER_STEP)]
        sizes = np.concatenate([np.diff(b) for _, b in parts])
        return np.concatenate([g for g, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])
    bounds = np.arange(len(starts) + 1)
    data, a, b = ragged.joined(*_ascending(rows, starts, ends))
    points, _ = code_points(ragged.Texts(np.concatenate([np.full(1, 0x20, np.uint8), data]), np.array([0, len(data) + 1])))
    stops = np.flatnonzero(points == 0x20)
    first, size = stops[:-1], np.diff(stops) + 1  # with both border spaces
    found, owner = [], []
    wide = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            count = np.maximum(size - n + 1, 0)
            at = ragged.spread(first, count)
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h += wide[at + k] * _MULTIPLIERS[k]
            found.append(ragged.mix(h))
            owner.append(np.repeat(bounds[:-1], count))
    found.append(ragged.hashes(data, a, b))
    owner.append(bounds[:-1])
    own = np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int32), np.searchsorted(own[order], bounds)


def _ascending(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[ragged.Texts, ragged.Words]:
    """The given ranges alone, one after another, whatever their order was."""
    length = ends - starts
    data = rows.data[ragged.spread(starts, length)]
    stop = np.cumsum(length)
    return ragged.Texts(data, np.concatenate([[0], stop])), ragged.Words(stop - length, stop, np.arange(len(stop) + 1))


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, end) of overlapping windows; the last one of a row ends with it."""
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    start = np.minimum(ragged.spread(np.zeros(len(n), np.int64), count) * STRIDE, np.maximum(n - WINDOW, 0)[row])
    first = bounds[:-1][row] + start
    return row, first, np.minimum(first + WINDOW, bounds[1:][row])


def row_logits(scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The highest window mean of each row's word scores (a short window is filled up with zeros)."""
    row, first, end = windows(bounds)
    out = np.zeros(len(bounds) - 1)
    if len(row):
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[begins]] = np.maximum.reduceat((sums[end] - sums[first]) / WINDOW, begins)
    return out


def train(rows: ragged.Texts, labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.3, seed: int = 7) -> Model:
    """Vectors and softmax weights by Adagrad on the cross-entropy of each text's most toxic window.

    The first epoch takes the whole text as one bag, so that windows are chosen by a model that has seen
    some. Both classes weigh the same.
    """
    rng = np.random.default_rng(seed)
    rows, found, h = word_ranges(rows)
    which, _, example = ragged.distinct(h)
    buckets, gram_bounds = subwords(rows, found.starts[example], found.ends[example])
    grams = np.diff(gram_bounds)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_t, seen_w, seen_b = np.full(BUCKETS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    all_rows, all_first, all_end = windows(found.bounds)
    window_bounds = np.searchsorted(all_rows, np.arange(len(labels) + 1))
    full = np.flatnonzero(np.diff(found.bounds) > 0)
    weight = (len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)).astype(np.float32)
    for epoch in range(epochs):
        order = rng.permutation(full)
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            if epoch == 0:
                first, end = found.bounds[docs], found.bounds[docs + 1]
            else:
                slope = table @ (weights[:, 1] - weights[:, 0]) if at % (16 * batch) == 0 else slope
                n = np.diff(window_bounds)[docs]
                own = ragged.spread(window_bounds[docs], n)
                length = all_end[own] - all_first[own]
                words = which[ragged.spread(all_first[own], length)]
                unique, back = np.unique(words, return_inverse=True)
                value = np.add.reduceat(slope[buckets[ragged.spread(gram_bounds[unique], grams[unique])]], np.cumsum(grams[unique]) - grams[unique]) / grams[unique]
                mean = np.add.reduceat(value[back], np.cumsum(length) - length)
                best = [int(np.argmax(mean[b : b + k])) + b for b, k in zip((np.cumsum(n) - n).tolist(), n.tolist())]
                first, end = all_first[own[best]], all_end[own[best]]
            length = end - first
            over = np.maximum(length, WINDOW).astype(np.float32)  # a short bag is filled up with zero vectors
            unique, back = np.unique(which[ragged.spread(first, length)], return_inverse=True)
            ids = buckets[ragged.spread(gram_bounds[unique], grams[unique])]
            begins = np.cumsum(grams[unique]) - grams[unique]
            vectors = np.add.reduceat(table[ids], begins) / grams[unique][:, None].astype(np.float32)
            bags = np.add.reduceat(vectors[back], np.cumsum(length) - length) / over[:, None]
            logits = bags @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), labels[docs]] -= 1
            p *= weight[labels[docs]][:, None] / len(docs)
            to_bags = (p @ weights.T) / over[:, None]
            to_words = np.zeros_like(vectors)
            np.add.at(to_words, back, np.repeat(to_bags, length, axis=0))
            to_words /= grams[unique][:, None].astype(np.float32)
            own, place = np.unique(ids, return_inverse=True)
            step = np.zeros((len(own), DIM), np.float32)
            np.add.at(step, place, np.repeat(to_words, grams[unique], axis=0))
            for now, past, change in ((weights, seen_w, bags.T @ p), (bias, seen_b, p.sum(0))):
                past += change * change
                now -= rate * change / np.sqrt(past)
            seen_t[own] += (step * step).mean(1)
            table[own] -= rate * step / np.sqrt(seen_t[own])[:, None]
    return Model((table @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores of texts; a word's score is worked out once while remembered."""

    def __init__(self, model: Model) -> None:
        self.model, self.memo = model, ragged.Memo(1)

    def __call__(self, chunk: ragged.Texts) -> np.ndarray:
        rows, found, h = word_ranges(chunk)
        which, keys, example = ragged.distinct(h)

        def compute(new: np.ndarray) -> np.ndarray:
            buckets, bounds = subwords(rows, found.starts[example[new]], found.ends[example[new]])
            return np.add.reduceat(self.model.bucket[buckets].astype(np.float64), bounds[:-1])[:, None] / np.diff(bounds)[:, None]

        scores = self.memo.get(keys, compute)[:, 0][which]
        return 1 / (1 + np.exp(-np.clip(row_logits(scores, found.bounds) + self.model.bias, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int) -> tuple[ragged.Texts, np.ndarray]:
    """Texts and labels to fit on: of each class the ``sample`` rows of ``labels`` with the smallest id hash,
    whose texts have at most LONGEST bytes. So at most 2 * sample * LONGEST bytes reach the driver."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    hashed = rows.withColumn("h", F.xxhash64("id"))
    chosen = [hashed.filter(F.col("label") == c).orderBy("h", "id").limit(sample) for c in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).filter(F.octet_length("text") <= LONGEST)
    got = own.join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("text").alias("text")).orderBy("id").toArrow()
    return ragged.texts(got["text"]), got["label"].to_numpy().astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model of ``label`` from the labelled documents; without any labels it scores 0.5 less a little."""
    rows, classes = labelled_sample(docs, labels, text, doc_id, label, sample)
    if not len(classes) or not len(rows.data):
        return Model(np.zeros(BUCKETS, np.float32), -1.0)
    return train(rows, classes)


def toxicity_scores(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """Kept columns, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on). One narrow pass over whole texts.

    The model has a fixed size (one number for each bucket). A null or empty text, or one without words, has
    the score of the bias alone; a document of any length counts whole; repeated rows score alike; an empty
    table gives an empty result; input columns named score or predicted are replaced.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast((model.bucket, model.bias)), f"toxicity {uuid.uuid4().hex}"

    def make():
        score = worker_object(key, lambda: Scorer(Model(*shared.value)))

        def columns(chunk: ragged.Texts):
            p = score(chunk)
            return [p, (p >= threshold).astype(np.int32)]

        return columns

    return with_text_columns(docs, text, fields(score="double", predicted="int"), make, keep, held=True)
