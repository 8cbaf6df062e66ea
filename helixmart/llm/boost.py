"""Gradient-boosted regression trees for two classes, over binned features, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of one depth; every split sends a row right if its feature is above a threshold."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, least: int = 20, pull: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.pull = trees, depth, rate, bins, least, pull
        self.start = 0.0
        self.forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])  # features x rows
        rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        margin = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, cuts, p - y, p * (1 - p))
            self.forest.append(tree)
            margin += self._apply(tree, x)
        return self

    def _grow(self, binned, cuts, gradient, curve):
        feature = np.zeros(2**self.depth - 1, dtype=np.int64)
        threshold = np.full(2**self.depth - 1, np.inf)
        at = np.zeros(binned.shape[1], dtype=np.int64)
        for node in range(2**self.depth - 1):
            rows = np.flatnonzero(at == node)
            best = (1e-6, -1, 0)
            if len(rows) >= 2 * self.least:
                g, h = gradient[rows], curve[rows]
                whole = g.sum() ** 2 / (h.sum() + self.pull)
                for f in range(len(cuts)):
                    b = binned[f, rows]
                    n = len(cuts[f]) + 1
                    if n < 2:
                        continue
                    gs, hs, ns = np.cumsum(np.bincount(b, g, n))[:-1], np.cumsum(np.bincount(b, h, n))[:-1], np.cumsum(np.bincount(b, minlength=n))[:-1]
                    gain = gs**2 / (hs + self.pull) + (g.sum() - gs) ** 2 / (h.sum() - hs + self.pull) - whole
                    gain[(ns < self.least) | (len(rows) - ns < self.least)] = -np.inf
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[1] >= 0:
                feature[node], threshold[node] = best[1], cuts[best[1]][best[2]]
                at[rows] = 2 * node + 1 + (binned[best[1], rows] > best[2])
            else:
                at[rows] = 2 * node + 1
        leaves = at - (2**self.depth - 1)
        size = 2**self.depth
        value = -self.rate * np.bincount(leaves, gradient, size) / (np.bincount(leaves, curve, size) + self.pull)
        return feature, threshold, value

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        feature, threshold, value = tree
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        return value[node - (2**self.depth - 1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        out = np.full(len(x), self.start)
        for tree in self.forest:
            out += self._apply(tree, x)
        return out
