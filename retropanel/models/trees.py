"""Fitted tree ensembles as flat node arrays, which score rows anywhere without the library."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)")
_WEIGHT = re.compile(r"Tree \d+ \(weight (\S+)\):")


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees in one numbering. A leaf has itself as both children; a row goes left where its
    feature is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """The weighted sum of the trees for each row of a (rows, features) matrix; all trees step at once."""
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        at = np.arange(len(rows))[:, None]
        while True:
            goes_left = rows[at, self.feature[node]] <= self.threshold[node]
            below = np.where(goes_left, self.left[node], self.right[node])
            if (below == node).all():
                return self.value[node] @ self.weights
            node = below


def flat_trees(model) -> FlatTrees:
    """The trees of a fitted ensemble over continuous features, read from its description."""
    feature, threshold, left, right, value, roots, weights = ([] for _ in range(7))

    def add(lines: list[str], at: int) -> tuple[int, int]:
        """Add the node that begins at a line: (its number, the line behind it)."""
        node = len(feature)
        for column, start in ((feature, 0), (threshold, 0.0), (left, node), (right, node), (value, 0.0)):
            column.append(start)
        if lines[at].startswith("Predict:"):
            value[node] = float(lines[at].split(":")[1])
            return node, at + 1
        found = _SPLIT.match(lines[at])
        if not found:
            raise ValueError(f"a split on categories: {lines[at]}")
        feature[node], threshold[node] = int(found[2]), float(found[4])
        left[node], behind = add(lines, at + 1)
        right[node], behind = add(lines, behind + 1)  # past the Else line
        return node, behind

    parts = re.split(_WEIGHT, model.toDebugString)
    for weight, body in zip(parts[1::2], parts[2::2]):
        lines = [line.strip() for line in body.splitlines() if line.strip()]
        roots.append(add(lines, 0)[0])
        weights.append(float(weight))
    return FlatTrees(np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(right, np.int64), np.array(value), np.array(roots, np.int64), np.array(weights))
