"""Gradient-boosted trees for two classes, in numpy: binned features, logistic loss, second-order leaf values."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    bias: float
    #: By tree and inner node, breadth first: the feature and the value above which a row goes right.
    feature: np.ndarray
    cut: np.ndarray
    #: By tree and leaf.
    value: np.ndarray
    depth: int

    def decision(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0) -> Boosted:
    weight = weight / weight.mean()
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], 1)  # above edge b: bin > b
    share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    score = np.full(len(y), bias)
    inner = 2**depth - 1
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for d in range(depth):
            n, first = 2**d, 2**d - 1
            best = np.full(n, 1e-6)
            where = np.zeros((n, 2), np.int64) - 1
            for k, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (node - first) * (len(e) + 1) + binned[:, k]
                gs = np.bincount(cell, g, n * (len(e) + 1)).reshape(n, -1).cumsum(1)
                hs = np.bincount(cell, h, n * (len(e) + 1)).reshape(n, -1).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                at = gain.argmax(1)
                top = gain[np.arange(n), at]
                better = top > best
                best[better], where[better, 0], where[better, 1] = top[better], k, at[better]
            right = np.zeros(len(y), bool)
            for j in np.flatnonzero(where[:, 0] >= 0):
                k, b = where[j]
                feature[t, first + j], cut[t, first + j] = k, edges[k][b]
                own = node == first + j
                right[own] = binned[own, k] > b
            node = 2 * node + 1 + right
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        value[t] = -rate * gs / (hs + ridge)
        score += value[t][leaf]
    return Boosted(bias, feature, cut, value, depth)
