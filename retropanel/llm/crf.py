"""A linear-chain conditional random field with two labels, in numpy.

A step has a score for label 1 (the sum of its features' weights) and a kind that says which transition matrix
leads to it. Training maximises the penalised likelihood with forward-backward over all chains at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Model(NamedTuple):
    weights: np.ndarray  # (features,)
    moves: np.ndarray  # (kinds, 2, 2): score of label b after label a
    begin: np.ndarray  # (2,)


class Chains(NamedTuple):
    """Chains laid end to end: ``bounds`` are their borders; ``codes[at[i]:at[i + 1]]`` are step i's features."""

    bounds: np.ndarray
    codes: np.ndarray
    at: np.ndarray
    kinds: np.ndarray


def scores(weights: np.ndarray, chains: Chains) -> np.ndarray:
    """The score of label 1 at every step; a step has at least one feature."""
    return np.add.reduceat(weights[chains.codes], chains.at[:-1]) if len(chains.at) > 1 else np.zeros(0)


def _steps(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains by falling length, and how many of them have a step t."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    return order, np.searchsorted(-lengths[order], -np.arange(longest), "left")


def viterbi(score: np.ndarray, kinds: np.ndarray, bounds: np.ndarray, model: Model) -> np.ndarray:
    """The likeliest labels of every step, all chains side by side; of equal ones, label 0."""
    order, live = _steps(bounds)
    first = bounds[:-1][order]
    back = np.zeros((len(score), 2), np.int8)
    best = np.zeros((len(order), 2))
    for t, n in enumerate(live):
        at = first[:n] + t
        if t == 0:
            best[:n] = model.begin
        else:
            ways = best[:n, :, None] + model.moves[kinds[at]]
            back[at] = ways.argmax(axis=1)
            best[:n] = ways.max(axis=1)
        best[:n, 1] += score[at]
    labels = np.zeros(len(score), np.int8)
    now = best.argmax(axis=1).astype(np.int8)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = first[:n] + t
        labels[at] = now[:n]
        now[:n] = back[at, now[:n]]
    return labels


def expectations(score: np.ndarray, kinds: np.ndarray, bounds: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """P(label 1) of every step, expected moves of each kind, expected first labels, log of all partitions."""
    order, live = _steps(bounds)
    first, steps = bounds[:-1][order], len(score)
    alpha, beta = np.zeros((steps, 2)), np.zeros((steps, 2))
    for t, n in enumerate(live):
        at = first[:n] + t
        alpha[at] = model.begin if t == 0 else np.logaddexp.reduce(alpha[at - 1][:, :, None] + model.moves[kinds[at]], axis=1)
        alpha[at, 1] += score[at]
    moves = np.zeros_like(model.moves)
    for t in range(len(live) - 1, 0, -1):
        at = first[: live[t]] + t
        ahead = beta[at] + np.stack([np.zeros(len(at)), score[at]], axis=1)
        beta[at - 1] = np.logaddexp.reduce(model.moves[kinds[at]] + ahead[:, None, :], axis=2)
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    total = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    norm = np.repeat(total, np.diff(bounds)[np.diff(bounds) > 0])
    begins = np.zeros(steps, bool)
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(~begins)
    ahead = beta[at] + np.stack([np.zeros(len(at)), score[at]], axis=1)
    pair = np.exp(alpha[at - 1][:, :, None] + model.moves[kinds[at]] + ahead[:, None, :] - norm[at][:, None, None])
    np.add.at(moves, kinds[at], pair)
    one = np.exp(alpha[:, 1] + beta[:, 1] - norm)
    return one, moves, np.array([(1 - one[begins]).sum(), one[begins].sum()]), float(total.sum())


def train(chains: Chains, labels: np.ndarray, features: int, kinds: int, rounds: int = 150, penalty: float = 3e-6, rate: float = 0.1) -> Model:
    """Weights, moves and first labels by gradient steps with running moments (Adam), from zero."""
    model = Model(np.zeros(features), np.zeros((kinds, 2, 2)), np.zeros(2))
    steps = len(labels)
    if not steps:
        return model
    y = labels.astype(float)
    owner = np.repeat(np.arange(steps), np.diff(chains.at))
    begins = np.zeros(steps, bool)
    begins[chains.bounds[:-1][np.diff(chains.bounds) > 0]] = True
    at = np.flatnonzero(~begins)
    seen_moves = np.zeros((kinds, 2, 2))
    np.add.at(seen_moves, (chains.kinds[at], labels[at - 1], labels[at]), 1)
    seen_begin = np.array([(labels[begins] == 0).sum(), (labels[begins] == 1).sum()], float)
    means, squares = [np.zeros_like(p) for p in model], [np.zeros_like(p) for p in model]
    for step in range(1, rounds + 1):
        one, moves, begin, _ = expectations(scores(model.weights, chains), chains.kinds, chains.bounds, model)
        slopes = [np.bincount(chains.codes, (y - one)[owner], features), seen_moves - moves, seen_begin - begin]
        changed = []
        for p, slope, m, v in zip(model, slopes, means, squares):
            slope = slope / steps - penalty * p
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            changed.append(p + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9))
        model = Model(*changed)
    return model
