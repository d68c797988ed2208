"""Gradient-boosted trees for two classes, over binned features; numpy only."""

from __future__ import annotations

import numpy as np

BINS = 48


class Trees:
    """Boosted trees of one depth; a tree is an array of (feature, bin) in heap order and leaf
    values. Fitting is deterministic."""

    def __init__(self, rounds: int = 80, depth: int = 4, rate: float = 0.15, ridge: float = 2.0):
        self.rounds, self.depth, self.rate, self.ridge = rounds, depth, rate, ridge
        self.edges: list[np.ndarray] = []
        self.base = 0.0
        self.features = np.zeros((0, 2**depth - 1), dtype=np.int64)
        self.cuts = np.zeros((0, 2**depth - 1), dtype=np.int64)
        self.leaves = np.zeros((0, 2**depth))

    def bins(self, x: np.ndarray) -> np.ndarray:
        binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        return np.stack(binned, axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        binned = self.bins(x)
        share = np.clip((y * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, weight * (y - p), weight * p * (1 - p))
            score = score + self._values(binned, *tree)
            trees.append(tree)
        self.features, self.cuts, self.leaves = (np.array(t) for t in zip(*trees, strict=True))
        return self

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, curvature: np.ndarray):
        inner = 2**self.depth - 1
        features, cuts = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        node = np.zeros(len(binned), dtype=np.int64)
        for level in range(self.depth):
            begin, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            for f in range(binned.shape[1]):
                at = (node - begin) * (BINS + 1) + binned[:, f]
                shape = (count, BINS + 1)
                size = count * (BINS + 1)
                g = np.bincount(at, gradient, size).reshape(shape).cumsum(axis=1)
                h = np.bincount(at, curvature, size).reshape(shape).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + self.ridge)
                    + (total_g - g) ** 2 / (total_h - h + self.ridge)
                    - total_g**2 / (total_h + self.ridge)
                )
                gain[(h < 1) | (total_h - h < 1)] = 0
                cut = gain.argmax(axis=1)
                value = gain[np.arange(count), cut]
                better = value > best
                best[better] = value[better]
                features[begin : begin + count][better] = f
                cuts[begin : begin + count][better] = cut[better]
            right = binned[np.arange(len(binned)), features[node]] > cuts[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, curvature, inner + 1)
        return features, cuts, self.rate * g / (h + self.ridge)

    def _values(self, binned, features, cuts, leaves) -> np.ndarray:
        node = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[rows, features[node]] > cuts[node])
        return leaves[node - (2**self.depth - 1)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        binned = self.bins(x)
        score = np.full(len(x), self.base)
        for tree in zip(self.features, self.cuts, self.leaves, strict=True):
            score += self._values(binned, *tree)
        return score
