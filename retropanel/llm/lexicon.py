"""BPE encoding through a minimal acyclic transducer of frequent words (operator 9).

The frequent words of the corpus are compiled into one acyclic automaton whose suffixes are shared; the
counts on its arcs add up to a word's number, and the number leads to its ids. Executors memory-map the
compiled file. Words outside it are merged exactly.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retropanel.llm import bpe, ragged
from retropanel.llm.common import bounded_batches, fields, release, stored, with_text_columns

#: The pre-token pattern of the word-end vocabulary; white space is dropped.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LONGEST = 32
_HEADER = 8


def compile_words(words: list[bytes], ids: np.ndarray, bounds: np.ndarray) -> bytes:
    """The automaton of ascending distinct words with their ids, as the bytes of one flat file.

    Words are added in order; once a later word leaves a branch, its states are final and each is replaced
    by an equal one if there is one, which shares the suffixes.
    """
    known: dict[tuple, int] = {}
    below: list[int] = []  # of a finished state: words accepted from it on
    shape: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def finish(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in known:
            known[key] = len(shape)
            shape.append(key)
            below.append(key[0] + sum(below[t] for _, t in key[1]))
        return known[key]

    path: list[list] = [[False, []]]  # accepting, finished arcs; labels[i] leads from path[i] to path[i + 1]
    labels: list[int] = []
    for word in words:
        same = 0
        while same < len(labels) and same < len(word) and labels[same] == word[same]:
            same += 1
        while len(labels) > same:
            done = finish(path.pop())
            path[-1][1].append((labels.pop(), done))
        for c in word[same:]:
            labels.append(c)
            path.append([False, []])
        path[-1][0] = True
    while labels:
        done = finish(path.pop())
        path[-1][1].append((labels.pop(), done))
    root = finish(path[0])
    keys, targets, skips = [], [], []
    for state, (accepts, arcs) in enumerate(shape):
        passed = int(accepts)
        for label, target in arcs:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(passed)
            passed += below[target]
    head = np.array([root, len(shape), len(keys), len(words), len(ids), 0, 0, 0], "<i8")
    arrays = [head, np.array(keys, "<i8"), bounds.astype("<i8"), np.array(targets, "<i4"), np.array(skips, "<i4"), ids.astype("<i4"), np.array([a for a, _ in shape], np.uint8)]
    return b"".join(a.tobytes() for a in arrays)


class Automaton:
    """A compiled file, memory-mapped. Many words step through it at once."""

    def __init__(self, raw: bytes) -> None:
        # the file has no name any more once mapped: nothing is left behind, and the page cache holds it
        with tempfile.TemporaryFile() as f:
            f.write(raw)
            f.flush()
            self.map = np.memmap(f, np.uint8, "r")
        self.root, self.states, arcs, self.words, n_ids = np.frombuffer(self.map[: 8 * _HEADER], "<i8")[:5].tolist()
        at = 8 * _HEADER

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * n
            at += size
            return self.map[at - size : at].view(kind)

        self.keys, self.bounds = part("<i8", arcs), part("<i8", self.words + 1)
        self.targets, self.skips, self.ids, self.accepts = part("<i4", arcs), part("<i4", arcs), part("<i4", n_ids), part("u1", self.states)

    def numbers(self, rows: ragged.Texts) -> np.ndarray:
        """The number of each word, -1 if it isn't in the lexicon."""
        n = len(rows.offsets) - 1
        out = np.full(n, -1, np.int64)
        length = np.diff(rows.offsets)
        live = np.flatnonzero(length <= LONGEST) if len(self.keys) else np.zeros(0, np.int64)
        state, number = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            ended = length[live] == step
            good = ended & (self.accepts[state] == 1)
            out[live[good]] = number[good]
            live, state, number = live[~ended], state[~ended], number[~ended]
            if not len(live):
                break
            key = state << 8 | rows.data[rows.offsets[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            live, arc = live[there], arc[there]
            state, number = self.targets[arc].astype(np.int64), number[there] + self.skips[arc]
            step += 1
        return out


def _splitter(vocabulary: str) -> Callable[[str], list[str]]:
    """Text to pre-tokens: the library's own normaliser and pre-tokeniser, which for ASCII are lower case
    and the pattern."""
    from tokenizers import Tokenizer

    library, pattern = Tokenizer.from_str(vocabulary), regex.compile(WORD_PATTERN)

    def split(text: str) -> list[str]:
        if text.isascii():
            return pattern.findall(text.lower())
        text = library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]

    return split


def frequent_words(docs: DataFrame, text: str = "text", size: int = 65_536) -> list[str]:
    """The most frequent words (runs without ASCII white space, up to 32 bytes) of all texts.

    Every task sums its words first, so a word that fills the corpus is one row of each. The words above the
    lowest count level that keeps no more than ``size`` of them reach the driver.
    """
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for _, chunk in ragged.chunks(ragged.texts(batch.column(0)), 8 * ragged.CHUNK_BYTES):
                found = ragged.words(chunk)
                place, distinct, example = ragged.distinct(ragged.hashes(chunk.data, found.starts, found.ends))
                counts = np.bincount(place, minlength=len(distinct))
                starts, ends = found.starts[example], found.ends[example]
                short = ends - starts <= LONGEST
                data = chunk.data.tobytes()
                words = [data[a:b] for a, b in zip(starts[short].tolist(), ends[short].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts[short])], ["word", "n"])

    counted = stored(bounded_batches(rows).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1"), "word-counts")
    # how many words reach each eighth of a power of two: the lowest level that keeps at most ``size`` words
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(((r["level"], r["n"]) for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = None, 0
    for at, n in levels:
        if held + n > size:
            break
        least, held = at, held + n
    if least is None:
        return []
    return sorted(bytes(r["word"]).decode("utf-8", "replace") for r in counted.filter(level >= least).select("word").collect())


def build(words: list[str], vocabulary: str) -> bytes:
    """The compiled lexicon of the pre-tokens of some words."""
    split, table = _splitter(vocabulary), bpe.MergeTable(vocabulary)
    tokens = sorted({t.encode() for w in words for t in split(w) if len(t.encode()) <= LONGEST})
    ids, bounds = table.merge(ragged.of_strings([t.decode() for t in tokens]))
    return compile_words(tokens, ids, bounds)


def lexicon_encoder(vocabulary: str, compiled: bytes) -> bpe.UnitEncoder:
    def make() -> bpe.UnitEncoder:
        split, table, automaton = _splitter(vocabulary), bpe.MergeTable(vocabulary), Automaton(compiled)
        specials = {t["content"]: t["id"] for t in json.loads(vocabulary)["added_tokens"]}
        around = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")")

        def coded(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
            tokens = [split(u) for u in units]
            place, distinct = pd.factorize(np.array([t for u in tokens for t in u], object))
            rows = ragged.of_strings(list(distinct))
            number = automaton.numbers(rows)
            unseen = np.flatnonzero(number < 0)
            merged, borders = table.merge(ragged.of_strings([distinct[i] for i in unseen.tolist()]))
            # one pool: the lexicon's ids, then the merged ones
            first = automaton.bounds[np.maximum(number, 0)].copy() if automaton.words else np.zeros(len(number), np.int64)
            n = automaton.bounds[np.maximum(number, 0) + 1] - first if automaton.words else np.zeros(len(number), np.int64)
            first[unseen], n[unseen] = borders[:-1] + len(automaton.ids), np.diff(borders)
            pool = np.concatenate([automaton.ids, merged])
            ids = pool[ragged.spread(first[place], n[place])]
            per_unit = np.concatenate([[0], np.cumsum([len(u) for u in tokens])]).astype(np.int64)
            return ids, np.concatenate([[0], np.cumsum(n[place])])[per_unit]

        def encode(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return coded(bpe.strings(rows, starts, ends))

        def whole(text: str) -> list[int]:
            out: list[int] = []
            for k, part in enumerate(around.split(text)):
                out.extend([specials[part]] if k % 2 else coded([part])[0].tolist() if part else [])
            return out

        return bpe.UnitEncoder(encode, whole, [s.encode() for s in specials], cut=ragged.words)

    return bpe.once("lexicon" + hashlib.sha256(compiled).hexdigest(), vocabulary, make)


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", size: int = 65_536, keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """Kept columns with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` of every text;
    with ``digests`` the SHA-256 of both in their place (``ids_sha256``, ``decoded_sha256``).

    One pass counts the words, a second one encodes. Decoding joins the tokens with spaces, as the library
    does for a file without a decoder. A null or empty text has no ids and decodes to the empty text;
    special strings in texts become their ids; an empty table gives an empty result (and an empty lexicon);
    repeated rows are encoded each; input columns with the names of new ones give way.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((vocabulary, build(frequent_words(docs, text, size), vocabulary)))
    kind = {"ids_sha256": "string", "decoded_sha256": "string"} if digests else {"ids": "binary", "decoded": "string"}

    def make():
        encoder = lexicon_encoder(*shared.value)
        parsed = json.loads(shared.value[0])
        names = {i: t for t, i in parsed["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parsed["added_tokens"]}
        spoken = [names.get(i, "").encode() for i in range(max(names) + 1)]

        def columns(chunk: ragged.Texts):
            ids, bounds = encoder.ids(chunk)
            raw, tokens, at = ids.astype("<u4").tobytes(), [spoken[i] for i in ids.tolist()], bounds.tolist()
            spans = list(zip(at, at[1:]))
            coded = [raw[4 * a : 4 * b] for a, b in spans]
            text = [b" ".join(tokens[a:b]) for a, b in spans]
            if digests:
                return [np.diff(bounds), [hashlib.sha256(x).hexdigest() for x in coded], [hashlib.sha256(x).hexdigest() for x in text]]
            return [np.diff(bounds), coded, [x.decode() for x in text]]

        return columns

    return with_text_columns(docs, text, fields(n_tokens="bigint", **kind), make, keep, held=True)
