"""Texts as arrays of lower-case code points and their letter runs."""

from __future__ import annotations

import functools

import numpy as np

from retropanel.llm import ragged

_TOP = 0x20000


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case (where it is one code point) and is-a-letter of the code points below 0x20000."""
    chars = [chr(i) for i in range(_TOP)]
    lower = np.array([ord(s) if len(s := c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32)
    return lower, np.array([c.isalpha() for c in chars])


def code_points(rows: ragged.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of a batch and the offsets of its rows among them."""
    points = np.frombuffer(rows.data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.concatenate([[0], np.cumsum((rows.data & 0xC0) != 0x80)])
    lower, _ = tables()
    return np.where(points < _TOP, lower[np.minimum(points, _TOP - 1)], points), before[rows.offsets]


def letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters; those above the tables count as such in the ideographic planes."""
    _, alpha = tables()
    return np.where(points < _TOP, alpha[np.minimum(points, _TOP - 1)], points < 0x323B0)
