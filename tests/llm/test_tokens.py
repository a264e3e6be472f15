import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from retropanel.llm import bpe, lexicon, packing, queries, ragged, token_counts, token_files
from retropanel.session import scratch_path
from tests.llm.conftest import EDGE

BYTE = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
WORD = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
BYTE_LIB, WORD_LIB = Tokenizer.from_str(BYTE), Tokenizer.from_str(WORD)
EDGE_TEXTS = [(r[0], r[1]) for r in EDGE]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXT = st.text(st.one_of(st.sampled_from(list("ab 'sdlrev\n\t  .,!1  　\x85é日")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_unit_encoders_equal_the_library(texts):
    want = [ids_of(BYTE_LIB, t) for t in texts]
    rows = ragged.of_strings(texts)
    for make in (bpe.library_encoder, bpe.merging_encoder):
        ids, bounds = make(BYTE).ids(rows)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
        assert make(BYTE).counts(rows).tolist() == [len(w) for w in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_transducer_equals_the_library(texts):
    encoder = lexicon.lexicon_encoder(WORD, lexicon.build(["the", "there", "then", "a1b", "'s", "naïve", "bathe"], WORD))
    ids, bounds = encoder.ids(ragged.of_strings(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(WORD_LIB, t) for t in texts]


def test_automaton_is_minimal_and_finds_its_words_only():
    words = sorted({a + b for a in ("", "st", "re", "pre") for b in ("art", "arts", "ing", "ings", "ore")})
    raw = lexicon.compile_words([w.encode() for w in words], np.arange(len(words)), np.arange(len(words) + 1))
    automaton = lexicon.Automaton(raw)
    found = automaton.numbers(ragged.of_strings([*words, "ar", "stin", "x", "", "artss"]))
    assert found.tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    # a minimal automaton has one state for each distinct set of endings
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for k in range(len(w) + 1) for p in [w[:k]]}
    assert automaton.states == len(endings)


def test_encoder_forgets_without_changing_results():
    encoder = bpe.UnitEncoder(bpe.merging_encoder(BYTE).encode, bpe.merging_encoder(BYTE).whole, [b"<|endoftext|>"], remember=3)
    for text in ("one two three four five", "six seven one", ""):
        assert encoder.ids(ragged.of_strings([text]))[0].tolist() == ids_of(BYTE_LIB, text)


@pytest.mark.parametrize("pairs", ["edge", "docs"])
def test_token_counts(request, pairs, texts):
    df, want = request.getfixturevalue(pairs), EDGE_TEXTS if pairs == "edge" else texts
    got = sorted(map(tuple, token_counts.token_counts(df, BYTE).collect()))
    assert got == sorted((d, len((t or "").encode()), n := len(ids_of(BYTE_LIB, t)), n > 512) for d, t in want)


@pytest.mark.parametrize("pairs", ["edge", "docs"])
def test_encode_decode(request, pairs, texts):
    df, want = request.getfixturevalue(pairs), EDGE_TEXTS if pairs == "edge" else texts
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in lexicon.encode_decode(df, WORD, size=500, digests=True).collect())
    rows = [(d, ids_of(WORD_LIB, t)) for d, t in want]
    assert got == sorted((d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(WORD_LIB.decode(i, skip_special_tokens=False).encode()).hexdigest()) for d, i in rows)
    plain = lexicon.encode_decode(df, WORD, size=500).collect()
    assert sorted((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in plain) == sorted((d, np.array(i, "<u4").tobytes(), WORD_LIB.decode(i, skip_special_tokens=False)) for d, i in rows)


@pytest.mark.parametrize("pairs", ["edge", "docs"])
def test_token_files_round_trip(spark, request, pairs, texts):
    df, want = request.getfixturevalue(pairs), EDGE_TEXTS if pairs == "edge" else texts
    path = scratch_path(spark, "test-files")
    token_files.write(df, BYTE, path)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    start = 0
    for r, (d, t) in zip(got, sorted(want, key=lambda p: p[0]), strict=True):
        ids = [*ids_of(BYTE_LIB, t), 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], crc(ids)) == (d, start, len(ids), zlib.crc32(r["ids"]))
        start += len(ids)


VALUES = st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=400)


@settings(max_examples=150, deadline=None)
@given(VALUES, st.integers(0, 3))
def test_simple8b_round_trip(values, zeros):
    array = np.concatenate([np.array(values, np.uint64), np.zeros(zeros * 250, np.uint64), np.array(values[::-1], np.uint64)] * 3)
    assert (token_files.decode(token_files.encode(array)) == array).all()


def test_simple8b_blocks_and_escapes():
    array = np.arange(3 * token_files.BLOCK + 5, dtype=np.uint64) ** np.uint64(4)
    array[7] = (1 << 64) - 1
    raw = token_files.encode(array)
    for b in range(4):
        assert (token_files.decode_block(raw, b) == array[b * token_files.BLOCK : (b + 1) * token_files.BLOCK]).all()
    assert len(token_files.encode(np.ones(6000, np.uint64))) < 1000
    with pytest.raises(ValueError):
        token_files.decode(b"nope" + raw[4:])


def packed(rows, want, capacity):
    """Checks of one packing; the number of its sequences."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    by_doc = defaultdict(list)
    for d, t in want:
        ids, at = [*ids_of(BYTE_LIB, t), 0], 0
        n = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        piece = 0
        while at < len(ids):
            by_doc[d].append((piece, at, n, crc(ids[at : at + n])))
            at, n, piece = at + n, capacity, piece + 1
    assert {d: sorted(p) for d, p in documents.items()} == {d: sorted(p) for d, p in by_doc.items()}
    return len(sequences)


def fewest(lengths, capacity):
    """Bins of best fit decreasing, one piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in left if r >= n]
        if fits:
            left[left.index(min(fits))] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_packing(spark, sf, texts, edge):
    got = queries.op8_best_fit_packing(spark, sf).collect()
    assert packed(got, texts, 2048) == fewest([r["length"] for r in got], 2048)
    from pyspark.sql import functions as F

    pieces = packing.cut(edge, BYTE, capacity=64)
    got = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")), 64).collect()
    assert packed(got, EDGE_TEXTS, 64) == fewest([r["length"] for r in got], 64)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15))
def test_plan_equals_one_by_one(counts):
    plan, bins = packing.best_fit_plan(counts, 40)
    assert bins == fewest([n for n, c in counts.items() for _ in range(c)], 40)
    used = defaultdict(list)
    ends = {}
    for k, (length, first, *_) in enumerate(plan.tolist()):
        ends[(length, first)] = plan[k + 1, 1] if k + 1 < len(plan) and plan[k + 1, 0] == length else counts[length]
    for length, first, at, offset, per in plan.tolist():
        for r in range(int(ends[(length, first)]) - first):
            used[at + r // per].append((offset + r % per * length, length))
    for places in used.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0


def test_empty_tables(spark, empty):
    assert token_counts.token_counts(empty, BYTE).count() == 0
    assert lexicon.encode_decode(empty, WORD).count() == 0
    assert packing.pack(packing.cut(empty, BYTE)).count() == 0
    path = scratch_path(spark, "test-files")
    token_files.write(empty, BYTE, path)
    assert token_files.read(spark, path).count() == 0


def test_special_strings_are_known():
    assert bpe.special_strings(BYTE) == [t["content"].encode() for t in json.loads(BYTE)["added_tokens"]]


def test_queries_equal_the_library(spark, sf, texts):
    """The rows of operators 4, 9 and 10 for every whole text, from the library alone."""
    docs = sorted(texts)
    ids = {d: ids_of(BYTE_LIB, t) for d, t in docs}
    start, want = 0, []
    for d, _ in docs:
        want.append((d, start, len(ids[d]) + 1, crc([*ids[d], 0])))
        start += len(ids[d]) + 1
    assert sorted(map(tuple, queries.op4_simple8b_token_files(spark, sf).collect())) == want
    counted = queries.op10_token_counts(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counted) == [(d, len((t or "").encode()), len(ids[d]), len(ids[d]) > 512) for d, t in docs]
    want = []
    for d, t in docs:
        own = ids_of(WORD_LIB, t)
        want.append((d, len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256(WORD_LIB.decode(own, skip_special_tokens=False).encode()).hexdigest()))
    got = queries.op9_transducer_bpe(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("remember", [1, 7, 60, 10_000])
def test_encoders_forget_without_losing(remember):
    """Any number of remembered units gives the library's ids, through many turns of the generations."""
    rng = np.random.default_rng(remember)
    library = bpe.UnitEncoder(lambda rows, a, b: bpe.ragged_ids([ids_of(BYTE_LIB, u) for u in bpe.strings(rows, a, b)]), lambda t: ids_of(BYTE_LIB, t), [], remember=remember)
    vocabulary = [f"word{i}" for i in range(200)]
    for _ in range(12):
        texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 40)))) for _ in range(8)]
        ids, bounds = library.ids(ragged.of_strings(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(BYTE_LIB, t) for t in texts]


def test_slots_and_memo_hold_every_key():
    rng = np.random.default_rng(6)
    slots, held = ragged.Slots(5000), {}
    for _ in range(10):
        keys = np.unique(rng.integers(0, 1 << 12, 500).astype(np.uint64) * np.uint64(1 << 20))
        found = slots.find(keys)
        assert found.tolist() == [held.get(max(k, 1), -1) for k in keys.tolist()]
        new = keys[found < 0]
        held.update(zip(np.maximum(new, 1).tolist(), slots.add(new).tolist()))
    memo, calls = ragged.Memo(2, remember=50), []
    for _ in range(30):
        keys = np.unique(rng.integers(1, 200, 40).astype(np.uint64))

        def compute(new, keys=keys):
            calls.extend(keys[new].tolist())
            return np.stack([keys[new] * 2.0, keys[new] * 3.0], 1)

        assert np.array_equal(memo.get(keys, compute), np.stack([keys * 2.0, keys * 3.0], 1))
    assert len(calls) > len(set(calls))


def greedy(values):
    """The selectors of the words, one word at a time."""
    out, at = [], 0
    while at < len(values):
        left = min(len(values), (at // token_files.BLOCK + 1) * token_files.BLOCK) - at
        if left >= 240 and not any(values[at : at + 240]):
            out.append(0)
            at += 240
            continue
        fits = [(k + 2, n) for k, (n, bits) in enumerate(token_files.PACKS) if n <= left and all(v >> bits == 0 for v in values[at : at + n])]
        k, n = fits[0] if fits else (1, 1)
        out.append(k)
        at += n
    return out


@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 1 << 40, 1 << 62])
def test_words_are_the_greedy_ones(top):
    rng = np.random.default_rng(top % 1000)
    for size in (0, 1, 59, 60, 61, 300, 4095, 4096, 4097, 9000):
        values = rng.integers(0, top, size).astype(np.uint64)
        values[rng.random(size) < 0.6] = 0
        if size > 50:
            values[size // 2] = np.uint64((1 << 64) - 1)
        raw = token_files.encode(values)
        assert np.array_equal(token_files.decode(raw), values)
        assert (token_files._parts(raw)[2] >> np.uint64(60)).astype(int).tolist() == greedy(values.tolist())
