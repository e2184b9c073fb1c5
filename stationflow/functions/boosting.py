"""Boosted regression trees on binned features in numpy, for the rows of one site inside a task.

The module imports nothing but numpy and travels with the task (pickled by value), so workers need neither the package nor its imports.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

BINS = 32


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner edges per feature: the distinct quantiles of its values."""
    at = np.arange(1, bins) / bins
    return [np.unique(np.quantile(column, at, method="lower")) for column in x.T]


def bin_codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)])


def grow(codes: np.ndarray, rest: np.ndarray, used: np.ndarray, depth: int, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and bin of each inner node (heap order; all rows go left where nothing is gained) and the leaves' values, from the rows ``used``.

    Every level takes one histogram of all its nodes and features; the split with the largest loss of squared error wins, the first of equals.
    """
    n_features = codes.shape[1]
    feature, border = np.zeros(2 ** depth - 1, dtype=np.int64), np.full(2 ** depth - 1, BINS, dtype=np.int64)
    codes, rest, node = codes[used], rest[used], np.zeros(int(used.sum()), dtype=np.int64)
    for level in range(depth):
        nodes = 2 ** level
        cell = ((np.arange(n_features) * nodes + node[:, None]) * BINS + codes).ravel()
        size = n_features * nodes * BINS
        n = np.bincount(cell, minlength=size).reshape(n_features, nodes, BINS).cumsum(axis=2)
        s = np.bincount(cell, weights=np.repeat(rest, n_features), minlength=size).reshape(n_features, nodes, BINS).cumsum(axis=2)
        n_all, s_all = n[:, :, -1:], s[:, :, -1:]
        allowed = (n >= min_rows) & (n_all - n >= min_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(allowed, s ** 2 / n + (s_all - s) ** 2 / (n_all - n) - s_all ** 2 / n_all, 0.0)
        gain = gain.transpose(1, 0, 2).reshape(nodes, -1)
        best = gain.argmax(axis=1)
        split = gain[np.arange(nodes), best] > 1e-12
        at = slice(nodes - 1, 2 * nodes - 1)
        feature[at] = np.where(split, best // BINS, 0)
        border[at] = np.where(split, best % BINS, BINS)
        node = node * 2 + (codes[np.arange(len(node)), feature[at][node]] > border[at][node])
    n = np.bincount(node, minlength=2 ** depth)
    return feature, border, np.bincount(node, weights=rest, minlength=2 ** depth) / np.maximum(n, 1)


def leaf_of(codes: np.ndarray, feature: np.ndarray, border: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
    for level in range(depth):
        at = 2 ** level - 1 + node
        node = node * 2 + (codes[rows, feature[at]] > border[at])
    return node


def boosted(x: np.ndarray, y: np.ndarray, trees: int, depth: int, step: float, share: float = 0.8, min_rows: int = 20, seed: int = 42) -> Iterator[tuple]:
    """The trees of a fit, one after the other: (edges, start, feature, border, values). Each learns from a drawn ``share`` of the rows."""
    edges = bin_edges(x)
    codes, draw, start = bin_codes(x, edges), np.random.default_rng(seed), float(y.mean())
    fitted = np.full(len(y), start)
    for _ in range(trees):
        used = draw.random(len(y)) < share
        feature, border, values = grow(codes, y - fitted, used, depth, min_rows)
        fitted += step * values[leaf_of(codes, feature, border, depth)]
        yield edges, start, feature, border, values


def staged_squares(x: np.ndarray, y: np.ndarray, held: np.ndarray, trees: list[int], depth: int, step: float, seed: int = 42) -> dict[int, float]:
    """Sum of squared errors on the rows ``held`` under the first t trees of one fit on the others, for every t in ``trees``."""
    out, codes, guess = {}, None, None
    for t, (edges, start, feature, border, values) in enumerate(boosted(x[~held], y[~held], max(trees), depth, step, seed=seed), 1):
        if codes is None:
            codes, guess = bin_codes(x[held], edges), np.full(int(held.sum()), start)
        guess += step * values[leaf_of(codes, feature, border, depth)]
        if t in trees:
            out[t] = float(((y[held] - guess) ** 2).sum())
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
