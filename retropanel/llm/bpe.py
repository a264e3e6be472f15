"""Byte-pair merges on ragged numpy arrays, and an encoder that remembers units already seen.

``MergeTable`` holds the merges of a tokenizer file; ``merge`` runs them on many pre-tokens at once.
``UnitEncoder`` cuts texts into units (see ``ragged.units``) and encodes each distinct unit once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

import numpy as np
import regex

from retropanel.llm import ragged
from retropanel.llm.common import worker_object

#: The pre-token pattern of byte-level vocabularies, with spaces kept.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max
PER_CALL = 1000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class MergeTable:
    """Merges as a sorted array of id pairs, with their ranks and the ids they make."""

    def __init__(self, vocabulary: str) -> None:
        model = json.loads(vocabulary)["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([ids[c] for c in letters], np.int32)
        self.final = np.array([ids[c + suffix] for c in letters], np.int32)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        table = np.array(pairs, np.int64)
        keys = (table[:, 0] << 32) | table[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = table[:, 2].astype(np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE).astype(np.int32)

    def merge(self, rows: ragged.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every pre-token and their borders: (ids, bounds).

        In each round every sequence applies its own lowest-ranked pair at all its places (of overlapping
        places, from the left every other one). Sequences with no pair left drop out.
        """
        data, offsets = rows
        n = len(offsets) - 1
        symbols = self.first[data]
        full = offsets[1:] > offsets[:-1]
        symbols[offsets[1:][full] - 1] = self.final[data[offsets[1:][full] - 1]]
        owner = np.repeat(np.arange(n), np.diff(offsets))
        done_symbols, done_owner = [], []
        inner = np.zeros(len(symbols), bool)
        inner[:-1] = owner[1:] == owner[:-1]
        rank = np.full(len(symbols), NONE, np.int32)
        at = np.flatnonzero(inner)
        rank[at] = self.pair_ranks(symbols[at], symbols[at + 1])
        while len(symbols):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.concatenate([begins, [len(symbols)]]))
            live = best < NONE
            if not live.all():
                keep = np.repeat(live, lengths)
                done_symbols.append(symbols[~keep])
                done_owner.append(owner[~keep])
                symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
                best, lengths = best[live], lengths[live]
                if not len(symbols):
                    break
            hit = rank == np.repeat(best, lengths)
            places = np.flatnonzero(hit)
            # in a run of neighbouring places only every other one can merge
            fresh = np.concatenate([[True], places[1:] != places[:-1] + 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols[places] = self.made[rank[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            moved = places - np.arange(len(places))  # their places once the right halves are gone
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            for at in (moved, moved[moved > 0] - 1):
                within = at[at + 1 < len(symbols)]
                same = owner[within] == owner[within + 1]
                rank[at] = NONE
                within = within[same]
                rank[within] = self.pair_ranks(symbols[within], symbols[within + 1])
        if not done_symbols:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        ids, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(n + 1))


class Generation:
    """The ids of up to ``most`` units in flat arrays: unit k has ``pool[first[k]:first[k] + count[k]]``."""

    def __init__(self, most: int) -> None:
        self.slots = ragged.Slots(most)
        self.first, self.count, self.pool, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32), 0

    def add(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        held = self.slots.held
        self.first = ragged.grown(self.first, held, np.cumsum(counts) - counts + self.size)
        self.count = ragged.grown(self.count, held, counts)
        self.pool = ragged.grown(self.pool, self.size, ids)
        self.size += len(ids)
        return self.slots.add(keys)

    def ids(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after another, and how many each has."""
        n = self.count[slot].astype(np.int64)
        return self.pool[ragged.spread(self.first[slot], n)], n


class UnitEncoder:
    """Encodes batches of texts by their units; a distinct unit is encoded once while it is remembered.

    ``encode(rows, starts, ends)`` gives the ids of byte ranges of a chunk, ``whole(text)`` those of a text
    that holds a special string, which units can't be cut around. ``remember`` bounds the memory, not the
    results: of two generations of so many units the older is forgotten when the younger is full, and units
    met again have moved on to the younger by then.
    """

    def __init__(self, encode: Callable[[ragged.Texts, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], whole: Callable[[str], list[int]], specials: list[bytes], cut: Callable[[ragged.Texts], ragged.Words] = ragged.units, remember: int = 400_000) -> None:
        self.encode, self.whole, self.specials, self.cut, self.remember = encode, whole, specials, cut, remember
        self.young, self.old = Generation(remember), None

    def slots_of(self, rows: ragged.Texts, found: ragged.Words) -> np.ndarray:
        """The slot of every unit of a chunk in the younger generation; unseen units are encoded."""
        hashed = ragged.hashes(rows.data, found.starts, found.ends)
        slot = self.young.slots.find(hashed)
        missing = np.flatnonzero(slot < 0)
        keys, example, place = np.unique(hashed[missing], return_index=True, return_inverse=True)
        if self.young.slots.held + len(keys) > self.young.slots.most or self.young.size > 16 * self.remember:
            missing = np.arange(len(hashed))
            keys, example, place = np.unique(hashed, return_index=True, return_inverse=True)
            self.old, self.young = self.young, Generation(max(self.remember, len(keys)))
        example, fresh = missing[example], np.empty(len(keys), np.int64)
        before = self.old.slots.find(keys) if self.old else np.full(len(keys), -1)
        again, new = before >= 0, before < 0
        if again.any():
            fresh[again] = self.young.add(keys[again], *self.old.ids(before[again]))
        if new.any():
            ids, bounds = self.encode(rows, found.starts[example[new]], found.ends[example[new]])
            fresh[new] = self.young.add(keys[new], ids.astype(np.uint32), np.diff(bounds))
        slot[missing] = fresh[place]
        return slot

    def special_rows(self, rows: ragged.Texts) -> list[int]:
        data, hits = rows.data.tobytes(), set()
        for s in self.specials:
            at = data.find(s)
            while at >= 0:
                hits.add(int(np.searchsorted(rows.offsets, at, "right")) - 1)
                at = data.find(s, at + 1)
        return sorted(i for i in hits if any(s in rows.row(i) for s in self.specials))

    def counts(self, rows: ragged.Texts) -> np.ndarray:
        """Number of ids of each row of a chunk."""
        found = self.cut(rows)
        slots = self.slots_of(rows, found)
        out = ragged.row_sums(self.young.count[slots].astype(np.int64), found.bounds)
        for i in self.special_rows(rows):
            out[i] = len(self.whole(rows.row(i).decode("utf-8", "replace")))
        return out

    def ids(self, rows: ragged.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk and the borders of its rows: (ids, bounds)."""
        found = self.cut(rows)
        slots = self.slots_of(rows, found)  # may turn the generations
        ids, n = self.young.ids(slots)
        sizes = ragged.row_sums(n, found.bounds)
        special = self.special_rows(rows)
        if special:
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            parts = [ids[bounds[i] : bounds[i + 1]] for i in range(len(sizes))]
            for i in special:
                parts[i] = np.array(self.whole(rows.row(i).decode("utf-8", "replace")), np.uint32)
                sizes[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, np.concatenate([[0], np.cumsum(sizes)])


def once(kind: str, vocabulary: str, make: Callable[[], object]) -> object:
    """The object of a kind for a vocabulary that this Python worker keeps."""
    return worker_object(f"{kind} {hashlib.sha256(vocabulary.encode()).hexdigest()}", make)


def special_strings(vocabulary: str) -> list[bytes]:
    return [t["content"].encode() for t in json.loads(vocabulary)["added_tokens"]]


def ragged_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.fromiter((i for x in lists for i in x), np.uint32, int(bounds[-1])), bounds.astype(np.int64)


def strings(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """Byte ranges as str."""
    data = rows.data.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]


def lines_of(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray, per: int = PER_CALL) -> list[str]:
    """Byte ranges with a newline behind each, so many to a text."""
    sizes = ends - starts + 1
    closes = np.cumsum(sizes)
    out = np.full(int(closes[-1]) if len(closes) else 0, 10, np.uint8)
    inside = np.ones(len(out), bool)
    inside[closes - 1] = False
    out[inside] = rows.data[ragged.spread(starts, sizes - 1)]
    raw, cuts = out.tobytes(), [0, *closes[per - 1 :: per].tolist()]
    if len(closes) % per:
        cuts.append(len(raw))
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def library_encoder(vocabulary: str, remember: int = 400_000) -> UnitEncoder:
    """Byte-level ids by the tokenizers library, each distinct unit encoded once."""

    def make() -> UnitEncoder:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(vocabulary)
        library.no_truncation()
        library.no_padding()

        newline = library.encode("\n", add_special_tokens=False).ids

        def encode(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Units that neither start nor end a run of white space go to the library as the lines of a
            few long texts: there a newline is a pre-token of its own, so the ids between newlines are
            those of the units."""
            space = ragged.white(rows.data)
            blank = (rows.data[starts] == 0x20) & (ends - starts > 1) & ~space[np.minimum(starts + 1, len(space) - 1)]
            plain = ~space[ends - 1] & (~space[starts] | blank) if len(newline) == 1 else np.zeros(len(starts), bool)
            lines, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
            found = [np.zeros(0, np.uint32)]
            for text in lines_of(rows, starts[lines], ends[lines]):  # one at a time: the library's results are large
                found.extend(np.array(e.ids, np.uint32) for e in library.encode_batch_fast([text], add_special_tokens=False))
            ids = np.concatenate(found)
            closes = np.flatnonzero(ids == newline[0]) if newline else np.zeros(0, np.int64)
            ids = np.delete(ids, closes)
            closes -= np.arange(len(closes))
            others, bounds = ragged_ids([e.ids for e in library.encode_batch_fast(strings(rows, starts[rest], ends[rest]), add_special_tokens=False)])
            # back into the order of the units
            first, n = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
            n[lines], n[rest] = np.diff(closes, prepend=0), np.diff(bounds)
            first[lines], first[rest] = closes - n[lines], bounds[:-1] + len(ids)
            return np.concatenate([ids, others])[ragged.spread(first, n)], np.concatenate([[0], np.cumsum(n)])

        return UnitEncoder(encode, lambda text: library.encode(text, add_special_tokens=False).ids, special_strings(vocabulary), remember=remember)

    return once("library", vocabulary, make)


def merging_encoder(vocabulary: str) -> UnitEncoder:
    """Byte-level ids by rank-synchronous merging of all unseen pre-tokens of a chunk at once."""

    def make() -> UnitEncoder:
        from tokenizers import Tokenizer

        table, pattern, library = MergeTable(vocabulary), regex.compile(BYTE_PATTERN), Tokenizer.from_str(vocabulary)
        specials = {t["content"]: t["id"] for t in json.loads(vocabulary)["added_tokens"]}
        around = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") if specials else None

        def split(text: str) -> list[str]:
            """Pre-tokens; beyond ASCII the library says what a letter is."""
            if text.isascii():
                return pattern.findall(text)
            return [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]

        def merged(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
            tokens = [split(u) for u in units]
            ids, bounds = table.merge(ragged.of_strings([t for u in tokens for t in u]))
            return ids, bounds[np.concatenate([[0], np.cumsum([len(u) for u in tokens])]).astype(np.int64)]

        def encode(rows: ragged.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return merged(strings(rows, starts, ends))

        def whole(text: str) -> list[int]:
            parts = around.split(text)
            out: list[int] = []
            for k, part in enumerate(parts):
                out.extend([specials[part]] if k % 2 else merged([part])[0].tolist() if part else [])
            return out

        return UnitEncoder(encode, whole, [s.encode() for s in specials])

    return once("merging", vocabulary, make)
