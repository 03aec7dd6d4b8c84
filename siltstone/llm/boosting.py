"""Gradient-boosted trees for two classes over binned features, for a bounded training sample."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

TREES = 60
DEPTH = 4
BINS = 32
_RATE = 0.25
_SHRINK = 2.0
_LEAST_CURVE = 2.0


class Boosted(NamedTuple):
    """Complete binary trees: ``feature`` and ``cut`` of the inner nodes level by level, ``leaf`` values, a start value."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        binned = bins(x, self.edges)
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                place = (1 << level) - 1 + node
                node = 2 * node + (binned[rows, feature[place]] > cut[place])
            out += leaf[node]
        return out


def bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(x.shape, np.uint8)
    for k, e in enumerate(edges):
        if len(e):
            out[:, k] = np.searchsorted(e, x[:, k], side="left")
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Newton boosting of the logistic loss; every split is the best of all features' bins."""
    edges = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))
        edges.append(values[:-1] if len(values) > 1 else values[:0])
    binned = bins(x, edges)
    columns = np.ascontiguousarray(binned.T).astype(np.int64)
    # Columns of two values are summed by one matrix product, the others counted bin by bin.
    flags = np.flatnonzero([len(e) == 1 for e in edges])
    numbers = np.flatnonzero([len(e) > 1 for e in edges])
    raised = np.ascontiguousarray(binned[:, flags].T).astype(float)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    features, cuts, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, curve = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros((1 << DEPTH) - 1, np.int64), np.full((1 << DEPTH) - 1, BINS, np.int64)
        for level in range(DEPTH):
            width = 1 << level
            all_g, all_h = np.bincount(node, slope, width)[:, None], np.bincount(node, curve, width)[:, None]

            def gain(left_g: np.ndarray, left_h: np.ndarray) -> np.ndarray:
                """What is won by dividing each node (row) so, for several ways (columns)."""
                right_g, right_h = all_g - left_g, all_h - left_h
                won = left_g**2 / (left_h + _SHRINK) + right_g**2 / (right_h + _SHRINK) - all_g**2 / (all_h + _SHRINK)
                return np.where((left_h < _LEAST_CURVE) | (right_h < _LEAST_CURVE), 0, won)

            inside = node[:, None] == np.arange(width)
            right = (raised @ (inside * slope[:, None])).T, (raised @ (inside * curve[:, None])).T
            won = [np.zeros((width, 1)), gain(all_g - right[0], all_h - right[1])]
            split = [np.array([[0, BINS]]), np.stack([flags, np.zeros_like(flags)], 1)]
            at = node * BINS
            for k in numbers:
                g = np.bincount(at + columns[k], slope, width * BINS).reshape(width, BINS)
                h = np.bincount(at + columns[k], curve, width * BINS).reshape(width, BINS)
                won.append(gain(np.cumsum(g, 1), np.cumsum(h, 1)))
                split.append(np.stack([np.full(BINS, k), np.arange(BINS)], 1))
            which, where = np.concatenate(split)[np.concatenate(won, 1).argmax(1)].T
            place = np.arange(width) + width - 1
            feature[place], cut[place] = which, where
            node = 2 * node + (columns[which[node], np.arange(len(y))] > where[node])
        leaf = np.bincount(node, slope, 1 << DEPTH) / (np.bincount(node, curve, 1 << DEPTH) + _SHRINK) * _RATE
        score += leaf[node]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(edges, np.array(features), np.array(cuts), np.array(leaves), start)
