"""Gradient-boosted binary classification trees over numpy arrays: histogram splits, logistic loss, complete trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class BoostedTrees:
    """Complete trees: feature and threshold of each inner node (breadth first), value of each leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.feature.shape[1] + 1)) if len(self.feature) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (len(feature))]
        return out


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0, least: float = 1.0) -> BoostedTrees:
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(f)]
    coded = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], axis=1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    score = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-score))
        g, h = q - y, q * (1 - q)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.full(width, 1e-6)
            total_g, total_h = np.bincount(at, weights=g, minlength=width), np.bincount(at, weights=h, minlength=width)
            for j in range(f):
                if not len(edges[j]):
                    continue
                key = at * (len(edges[j]) + 1) + coded[:, j]
                size = width * (len(edges[j]) + 1)
                left_g = np.cumsum(np.bincount(key, weights=g, minlength=size).reshape(width, -1), axis=1)[:, :-1]
                left_h = np.cumsum(np.bincount(key, weights=h, minlength=size).reshape(width, -1), axis=1)[:, :-1]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - (total_g**2 / (total_h + ridge))[:, None]
                gain[(left_h < least) | (right_h < least)] = -1.0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better] = value[better]
                feature[first : first + width][better] = j
                threshold[first : first + width][better] = edges[j][top[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + ridge)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return BoostedTrees(base, np.array(features), np.array(thresholds), np.array(values))
