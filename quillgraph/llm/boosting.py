"""Gradient-boosted trees for a yes/no target, with histogram splits; small enough to be sent to every worker."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class BoostedTrees:
    """Complete binary trees: split features and limits by node, and a value for each leaf."""

    bias: float
    features: np.ndarray  # [trees, 2^depth - 1]
    limits: np.ndarray
    values: np.ndarray  # [trees, 2^depth]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, depth = np.full(len(x), self.bias), int(self.values.shape[1]).bit_length() - 1
        rows = np.arange(len(x))
        for features, limits, values in zip(self.features, self.limits, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, features[node]] > limits[node])
            out += values[node - (len(features))]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, smooth: float = 1.0) -> BoostedTrees:
    """Newton boosting of the logistic loss; every split is the one of most gain over quantile bins."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    score = np.full(n, bias)
    inner, leaves = (1 << depth) - 1, 1 << depth
    model = BoostedTrees(bias, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            base, width = (1 << level) - 1, 1 << level
            local = node - base
            best_gain = np.full(width, 1e-9)
            for f in range(m):
                k = len(edges[f]) + 1
                if k < 2:
                    continue
                at = local * k + binned[:, f]
                left_g = np.bincount(at, g, width * k).reshape(width, k).cumsum(1)
                left_h = np.bincount(at, h, width * k).reshape(width, k).cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + smooth) + (all_g - left_g) ** 2 / (all_h - left_h + smooth) - all_g**2 / (all_h + smooth)
                cut = gain[:, :-1].argmax(axis=1)
                value = gain[np.arange(width), cut]
                for i in np.flatnonzero(value > best_gain):
                    best_gain[i] = value[i]
                    model.features[t, base + i], model.limits[t, base + i] = f, edges[f][cut[i]]
            node = 2 * node + 1 + (x[np.arange(n), model.features[t, node]] > model.limits[t, node])
        leaf = node - inner
        model.values[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + smooth)
        score += model.values[t][leaf]
    return model
