"""Gradient-boosted trees for two classes: logistic loss, binned features, trees of equal depth kept as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class BoostedTrees:
    edges: list[np.ndarray]  # of each feature's bins
    features: np.ndarray  # trees x inner nodes
    splits: np.ndarray  # a row goes right if its bin is greater
    values: np.ndarray  # trees x leaves
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(e, x[:, j], "left")
        return out

    def margin(self, x: np.ndarray, block: int = 16_384) -> np.ndarray:
        """Log-odds of the rows; a block of them is binned at a time, which bounds the memory for large pages."""
        if len(x) > block:
            return np.concatenate([self.margin(x[i : i + block]) for i in range(0, len(x), block)])
        binned, out, rows = self.bins(x), np.full(len(x), self.base), np.arange(len(x))
        inner = self.features.shape[1]
        depth = (inner + 1).bit_length() - 1
        for f, s, v in zip(self.features, self.splits, self.values):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[rows, f[node]] > s[node])
            out += v[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 16, ridge: float = 1.0, least: float = 1.0) -> BoostedTrees:
    """Newton boosting; each level's histograms of all its nodes are made with one count over (node, bin)."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = BoostedTrees(edges, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth)), float(np.log(rate0 / (1 - rate0))))
    binned, margin = model.bins(x).astype(np.int64), np.full(len(x), model.base)
    features, splits, values = [], [], []
    useful = [j for j in range(x.shape[1]) if binned[:, j].min() < binned[:, j].max()]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        f, s = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for j in useful:
                at = (node - first) * bins + binned[:, j]
                gs = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain[(hs < least) | (ht - hs < least)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better] = value[better]
                f[first : first + width][better] = j
                s[first : first + width][better] = top[better]
            node = 2 * node + 1 + (binned[np.arange(len(x)), f[node]] > s[node])
        leaf = node - (2**depth - 1)
        v = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        margin += v[leaf]
        features.append(f)
        splits.append(s)
        values.append(v)
    model.features, model.splits, model.values = np.stack(features), np.stack(splits), np.stack(values)
    return model
