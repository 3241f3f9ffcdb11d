"""Histogram gradient-boosted trees in numpy, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of one depth: node k's children are 2k+1 and 2k+2; leaves come last."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # a value above the limit goes right
    leaf: np.ndarray  # trees x leaves
    depth: int

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches, all trees at once, level by level."""
        out = np.full(len(rows), self.start)
        trees = np.arange(len(self.feature))
        for begin in range(0, len(rows), 2048):
            part = rows[begin : begin + 2048]
            at = np.zeros((len(part), len(trees)), np.int64)
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (part[row, self.feature[trees, at]] > self.limit[trees, at])
            out[begin : begin + 2048] += self.leaf[trees, at - self.feature.shape[1]].sum(axis=1)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(rows)))


def fit(rows: np.ndarray, label: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.1, ridge: float = 1.0, least: int = 20) -> Forest:
    """Logistic boosting. Each level sums gradients by (node, feature, bin) and takes the best cut of every node."""
    rows, label = np.asarray(rows, np.float64), np.asarray(label, np.float64)
    width = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], rows[:, j], side="left") for j in range(width)], axis=1)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    raw = np.full(len(rows), start)
    inner = 2**depth - 1
    feature, limit, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2**depth))
    column = np.arange(width) * bins
    for tree in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        slope, bend = label - p, p * (1 - p)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            cell = ((at - first)[:, None] * (width * bins) + column + binned).ravel()
            size = nodes * width * bins
            sums = [np.bincount(cell, np.repeat(w, width), size).reshape(nodes, width, bins) for w in (slope, bend, np.ones(len(rows)))]
            left = [s.cumsum(axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            right = [w - x for w, x in zip(whole, left)]
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - whole[0] ** 2 / (whole[1] + ridge)
            gain[(left[2] < least) | (right[2] < least)] = -np.inf
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                j, b = divmod(int(best[node]), bins)
                if gain[node, j, b] > 1e-9 and b < len(cuts[j]):
                    feature[tree, first + node], limit[tree, first + node] = j, cuts[j][b]
            at = 2 * at + 1 + (rows[np.arange(len(rows)), feature[tree, at]] > limit[tree, at])
        place = at - inner
        leaf[tree] = rate * np.bincount(place, slope, 2**depth) / (np.bincount(place, bend, 2**depth) + ridge)
        raw += leaf[tree][place]
    return Forest(start, feature, limit, leaf, depth)
