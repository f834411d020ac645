"""Gradient-boosted trees of equal depth for two classes, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Per tree and inner node a feature and a bound (right if above), per leaf a value."""

    base: float
    features: np.ndarray
    bounds: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, bound, value in zip(self.features, self.bounds, self.values):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            total += value[node - len(feature)] if len(node) else 0
        return total


def boost(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Trees:
    """Trees fitted one after another to the gradient of the logistic loss."""
    inner = 2**depth - 1
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)], axis=1)
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    total = np.full(len(x), base)
    features = np.zeros((trees, inner), np.int64)
    bounds = np.full((trees, inner), np.inf)
    values = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f, column in enumerate(binned.T):
                cell = local * BINS + column
                g = np.bincount(cell, slope, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(cell, curve, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain = gain[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(axis=1)
                won = gain[np.arange(width), at] > best
                best[won] = gain[np.arange(width), at][won]
                features[t, first : first + width][won] = f
                bounds[t, first : first + width][won] = edges[f][at[won]]
            node = 2 * node + 1 + (x[np.arange(len(x)), features[t, node]] > bounds[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
        values[t] = -rate * g / (h + ridge)
        total += values[t][leaf]
    return Trees(base, features, bounds, values)
