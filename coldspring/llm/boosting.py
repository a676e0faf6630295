"""Gradient-boosted trees for two classes, fitted on a bounded sample in memory."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of equal depth: feature and threshold of each inner node, value of each leaf, level by level."""
    base: float
    depth: int
    feature: np.ndarray     # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray       # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the positive class."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2 ** self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, penalty: float = 2.0) -> Trees:
    """Second-order boosting of the logistic loss; splits are searched in histograms of at most ``bins`` values per feature."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1).astype(np.int64)
    n_features, width = x.shape[1], bins + 1
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    score = np.full(len(y), base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    features, thresholds, values = [], [], []
    offsets = np.arange(n_features) * width
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, bend = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            cell = ((at - first) * n_features * width)[:, None] + offsets[None, :] + binned
            size = count * n_features * width
            g = np.bincount(cell.ravel(), weights=np.repeat(gradient, n_features), minlength=size).reshape(count, n_features, width).cumsum(axis=2)
            h = np.bincount(cell.ravel(), weights=np.repeat(bend, n_features), minlength=size).reshape(count, n_features, width).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g ** 2 / (all_h + penalty)
            flat = gain[:, :, :-1].reshape(count, -1)
            best = flat.argmax(axis=1)
            for node in range(count):
                f, b = divmod(int(best[node]), width - 1)
                if flat[node, best[node]] > 1e-6 and b < len(cuts[f]):
                    feature[first + node], threshold[first + node] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, weights=gradient, minlength=leaves) / (np.bincount(leaf, weights=bend, minlength=leaves) + penalty)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(base, depth, np.array(features), np.array(thresholds), np.array(values))
