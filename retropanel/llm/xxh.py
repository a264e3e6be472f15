"""XXH64 of many byte ranges at once."""

from __future__ import annotations

import numpy as np
import xxhash

from retropanel.llm import ragged

#: The five primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """The unsigned hash of each range. Ranges below 64 bytes go through whole-array steps, longer ones one
    by one through the library."""
    length = ends - starts
    out = np.empty(len(starts), np.uint64)
    long = ragged.padded(data)
    order = np.argsort(np.minimum(length, 64).astype(np.uint8), kind="stable")
    small = int(np.searchsorted(length[order], 64)) if len(order) else 0
    for i in order[small:].tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    order = order[:small]
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        size, at = length[order], starts[order].copy()
        h = np.full(len(order), s + P5, np.uint64)
        wide = int(np.searchsorted(size, 32))
        if wide < len(order):
            sums = [_round(np.full(len(order) - wide, v, np.uint64), ragged.words_at(long, at[wide:] + 8 * k)) for k, v in enumerate((s + P1 + P2, s + P2, s, s - P1))]
            x = _rotl(sums[0], 1) + _rotl(sums[1], 7) + _rotl(sums[2], 12) + _rotl(sums[3], 18)
            for v in sums:
                x = (x ^ _round(np.uint64(0), v)) * P1 + P4
            h[wide:] = x
            at[wide:] += 32
        h += size.astype(np.uint64)
        rest = size % 32
        # the tail: whole 8-byte words, then one of 4 bytes, then single bytes
        for k in range(3):
            own = np.flatnonzero(rest >= 8 * (k + 1))
            h[own] = _rotl(h[own] ^ _round(np.uint64(0), ragged.words_at(long, at[own])), 27) * P1 + P4
            at[own] += 8
        own = np.flatnonzero(rest % 8 >= 4)
        h[own] = _rotl(h[own] ^ (ragged.words_at(long, at[own]) & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
        at[own] += 4
        for k in range(3):
            own = np.flatnonzero(rest % 4 > k)
            h[own] = _rotl(h[own] ^ long[at[own]] * P5, 11) * P1
            at[own] += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[order] = h ^ (h >> np.uint64(32))
    return out
