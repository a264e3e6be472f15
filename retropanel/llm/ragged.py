"""Vectorised work on a batch of texts: byte arrays, words, hashes and ragged gathers.

A batch is one byte array and its row offsets, taken from Arrow buffers without making Python strings.
Words and units are (start, end) arrays into that byte array; everything here works on whole arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 19
_SEGMENT = 1 << 18
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + _RANDOM.integers(0, 2, 256, dtype=U64)
_BASE = 0x9E3779B97F4A7C17
_POWERS: list[np.ndarray] = []

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


class Texts(NamedTuple):
    """Rows of UTF-8 text: row i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def row(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    _, where, data = column.buffers()
    if n == 0 or where is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, offsets - first)


def of_strings(values: list[str | None]) -> Texts:
    return texts(pa.array(values, pa.large_string()))


def chunks(rows: Texts, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Texts]]:
    """Whole rows, ``limit`` bytes or one row at a time: (number of the first row, its chunk)."""
    start, n = 0, len(rows.offsets) - 1
    while start < n:
        stop = int(np.searchsorted(rows.offsets, rows.offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        part = rows.offsets[start : stop + 1]
        yield start, Texts(rows.data[part[0] : part[-1]], part - part[0])
        start = stop


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            size = max(n, _SEGMENT)
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(size, base, U64)
                p[0] = 1
                _POWERS.append(np.multiply.accumulate(p))
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word at each byte position; ``data`` needs 8 bytes of padding."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))[at]


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U64)


def padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range (ranges ascend and don't overlap).

    A polynomial hash from prefix sums, joined with the first eight bytes and the length. Long arrays are
    done in segments of whole ranges, so the prefix sums stay small.
    """
    out = np.empty(len(starts), U64)
    long = padded(data)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = int(starts[at])
            stop = int(np.searchsorted(ends, low + _SEGMENT, "right"))
            stop = max(stop, at + 1)
            s, e = starts[at:stop] - low, ends[at:stop] - low
            size = int(e[-1])
            up, down = _powers(size + 1)
            sums = np.empty(size + 1, U64)
            sums[0] = 0
            np.cumsum(_BYTE[data[low : low + size]] * up[:size], out=sums[1:])
            h = (sums[e] - sums[s]) * down[s]
            head = words_at(long, starts[at:stop]) & _KEEP[np.minimum(e - s, 8)]
            out[at:stop] = mix(h ^ mix(head + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93)))
            at = stop
    return out


class Words(NamedTuple):
    """Ranges of a batch: ``row`` says whose each is; ``bounds[i]:bounds[i + 1]`` are those of row i."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(rows: Texts, gaps: np.ndarray = _SPACE) -> Words:
    """Maximal runs of bytes not marked in ``gaps`` (space and 0x09-0x0D); none crosses a row border."""
    data, offsets = rows
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    space = gaps[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = space[1:] != space[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    inside = ~space[at[:-1]]
    starts, ends = at[:-1][inside], at[1:][inside]
    return Words(starts, ends, np.searchsorted(starts, offsets))


#: The white space of Unicode beyond ASCII, in UTF-8.
_WIDE_SPACE = {b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80"} | {bytes((0xE2, 0x80, 0x80 + k)) for k in range(11)}
_WIDE_LEADS = np.zeros(256, bool)
_WIDE_LEADS[[w[0] for w in _WIDE_SPACE]] = True


def white(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a white-space character of Unicode."""
    out = _SPACE[data]
    leads = np.flatnonzero(_WIDE_LEADS[data])
    if len(leads):
        # e2 80 also begins dashes and quotes, so look at whole characters of the few leads
        long = padded(data)
        three = (long[leads].astype(np.uint32) << 16) | (long[leads + 1].astype(np.uint32) << 8) | long[leads + 2]
        for w in _WIDE_SPACE:
            code = int.from_bytes(w.ljust(3, b"\0"), "big")
            hit = leads[(three >> (8 * (3 - len(w)))) == (code >> (8 * (3 - len(w))))]
            for k in range(len(w)):
                out[hit + k] = True
    return out


def units(rows: Texts) -> Words:
    """Ranges that byte-level BPE encodes independently: no pre-token crosses their borders.

    A text is cut before each run of white space, before the last character of a run that a word follows,
    and after that character unless it is a plain space (a pre-token takes one leading space along).
    """
    data, offsets = rows
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    space = white(data)
    cut = np.zeros(n + 1, bool)
    cut[1:n] = space[1:] & ~space[:-1]
    cut[offsets] = True
    # the last white byte before a word, in the same row
    last = np.flatnonzero(space[:-1] & ~space[1:])
    last = last[~np.isin(last + 1, offsets) & (data[last] < 0x80)]
    cut[last] = True
    cut[last[data[last] != 0x20] + 1] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    return Words(starts, ends, np.searchsorted(starts, offsets))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every range, one after another."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of each row's values; a row without any gets 0."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def joined(rows: Texts, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each, and where each now starts and ends."""
    lengths = found.ends - found.starts
    starts = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    inside = np.zeros(len(rows.data) + 1, np.int8)
    inside[found.starts] += 1
    np.subtract.at(inside, found.ends, 1)
    taken = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    kept = np.ones(len(out), bool)
    kept[starts + lengths] = False
    out[kept] = rows.data[taken]
    return out, starts, starts + lengths


class Slots:
    """Numbers from 0 for up to ``most`` 64-bit keys: two flat arrays, open addressing, whole batches at once."""

    def __init__(self, most: int) -> None:
        size = 1 << max(2 * most - 1, 15).bit_length()
        self.most, self.held, self._mask = most, 0, U64(size - 1)
        self._keys, self._slots = np.zeros(size, U64), np.zeros(size, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those not held."""
        keys = np.maximum(keys, U64(1))  # 0 marks a free place
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys & self._mask
        while len(todo):
            there = self._keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = self._slots[at[hit]]
            on = ~hit & (there != 0)
            todo, at = todo[on], (at[on] + U64(1)) & self._mask
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Number distinct keys that are not held, in their order."""
        keys = np.maximum(keys, U64(1))
        new = np.arange(self.held, self.held + len(keys))
        self.held += len(keys)
        todo, at = np.arange(len(keys)), keys & self._mask
        while len(todo):
            free = self._keys[at] == 0
            self._keys[at[free]] = keys[todo[free]]  # of several keys for one place the last one stays
            won = self._keys[at] == keys[todo]
            self._slots[at[won]] = new[todo[won]]
            todo, at = todo[~won], (at[~won] + U64(1)) & self._mask
        return new


def grown(kept: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``kept`` with ``more`` behind its first ``used`` rows; room doubles when it runs out."""
    if used + len(more) > len(kept):
        room = np.empty((max(2 * len(kept), used + len(more)), *kept.shape[1:]), kept.dtype)
        room[:used] = kept[:used]
        kept = room
    kept[used : used + len(more)] = more
    return kept


class Memo:
    """Rows of numbers by 64-bit key, computed once while remembered.

    Two generations of up to ``remember`` keys: a full one becomes the older one, and what is asked for again
    moves on to the younger, so frequent keys are never forgotten.
    """

    def __init__(self, width: int, remember: int = 300_000) -> None:
        self.width, self.remember = width, remember
        self.young, self.old = self._fresh(remember), None

    def _fresh(self, most: int) -> tuple[Slots, list[np.ndarray]]:
        return Slots(most), [np.zeros((0, self.width), np.float64)]

    def get(self, keys: np.ndarray, compute: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """A row for each of the distinct keys; ``compute`` gets the places of those not held."""
        slots, rows = self.young
        if slots.held + len(keys) > slots.most:
            self.old, self.young = self.young, self._fresh(max(self.remember, len(keys)))
            slots, rows = self.young
        slot = slots.find(keys)
        new = np.flatnonzero(slot < 0)
        if len(new):
            made, unseen = np.empty((len(new), self.width)), np.arange(len(new))
            if self.old:
                before = self.old[0].find(keys[new])
                made[before >= 0] = self.old[1][0][before[before >= 0]]
                unseen = np.flatnonzero(before < 0)
            if len(unseen):
                made[unseen] = compute(new[unseen])
            rows[0] = grown(rows[0], slots.held, made)
            slot[new] = slots.add(keys[new])
        return rows[0][slot]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which distinct key each is, the distinct keys, the first place of each)."""
    import pandas as pd

    which, own = pd.factorize(keys)
    first = np.empty(len(own), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    return which, own, first
