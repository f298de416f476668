"""Gradient-boosted trees for two classes, small enough to travel with a task."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, trees of fixed depth over bins of the features."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 24, least: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        x, y = np.asarray(x, float), np.asarray(y, float)
        w = np.ones(len(y)) if weight is None else weight
        self.cuts = [self._cuts(c) for c in x.T]
        b = np.stack([np.searchsorted(k, c, side="right") for k, c in zip(self.cuts, x.T)], 1)
        p = np.clip(np.average(y, weights=w), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        f = np.full(len(y), self.base)
        n_bins = self.bins + 1
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-f))
            g, h = (y - prob) * w, np.maximum(prob * (1 - prob), 1e-6) * w
            node = np.zeros(len(y), int)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, n_bins)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                local = node - first
                for j in range(x.shape[1]):
                    at = local * n_bins + b[:, j]
                    gs = np.bincount(at, g, count * n_bins).reshape(count, n_bins).cumsum(1)
                    hs = np.bincount(at, h, count * n_bins).reshape(count, n_bins).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[(hs < self.least) | (ht - hs < self.least)] = 0
                    k = gain.argmax(1)
                    value = gain[np.arange(count), k]
                    better = value > best
                    best = np.where(better, value, best)
                    feature[first : first + count][better] = j
                    cut[first : first + count][better] = k[better]
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + 1) * self.rate
            limits = np.array([self.cuts[j][c] if c < len(self.cuts[j]) else np.inf for j, c in zip(feature, cut)])
            self.trees.append((feature, limits, value))
            f += value[leaf]
        return self

    def _cuts(self, values: np.ndarray) -> np.ndarray:
        """Between all values where they are few, else at quantiles of the rows and of the distinct values, so that rare ones are told apart."""
        distinct = np.unique(values)
        if len(distinct) <= self.bins:
            return (distinct[1:] + distinct[:-1]) / 2
        at = np.linspace(0, 1, self.bins // 2 + 2)[1:-1]
        return np.unique(np.r_[np.quantile(values, at), np.quantile(distinct, at)])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        x = np.asarray(x, float)
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limits, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= limits[node])
            f += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-f))
