"""Gradient-boosted trees for a bounded training sample (logistic loss).

Features are cut at quantiles into at most CUTS + 1 bins; a tree grows level
by level, each level from one gradient histogram per feature.  A fitted
model is a few arrays, small enough to send to every task, and scores a
matrix of rows without loops over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, CUTS, RATE, RIDGE, LEAST = 60, 4, 31, 0.25, 1.0, 1e-3


@dataclass
class Boosted:
    base: float
    feature: np.ndarray    # trees x inner nodes (heap order)
    threshold: np.ndarray  # go right if value > threshold
    leaf: np.ndarray       # trees x leaves

    def decide(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2 ** DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1])) for j in range(width)]
    # a rare flag is constant at all quantiles: its own values cut it
    cuts = [np.unique(x[:, j])[:-1] if len(np.unique(x[:, j])) <= 8 else c for j, c in enumerate(cuts)]
    bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    slots = CUTS + 2
    share = float((weight * y).sum() / weight.sum())
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    score = np.full(n, base)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    feature = np.zeros((TREES, inner), dtype=np.int64)
    threshold = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, leaves))
    offset = np.arange(width) * slots
    for k in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), np.maximum(weight * p * (1 - p), 1e-12)
        at = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2 ** level - 1, 2 ** level
            key = ((at - first)[:, None] * width * slots + offset + bins).ravel()
            size = count * width * slots
            sums = [np.bincount(key, np.repeat(v, width), size).reshape(count, width, slots) for v in (g, h)]
            left_g, left_h = (np.cumsum(v, axis=2) for v in sums)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = (left_g ** 2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g ** 2 / (all_h + RIDGE))
            gain[(left_h < LEAST) | (all_h - left_h < LEAST)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            f, b = best // slots, best % slots
            for node in range(count):
                if gain[node, f[node], b[node]] > 1e-9 and b[node] < len(cuts[f[node]]):
                    feature[k, first + node] = f[node]
                    threshold[k, first + node] = cuts[f[node]][b[node]]
            at = 2 * at + 1 + (x[np.arange(n), feature[k, at]] > threshold[k, at])
        at -= inner
        leaf[k] = RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        score += leaf[k][at]
    return Boosted(base, feature, threshold, leaf)
