"""Gradient-boosted trees on binned features, in numpy, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class BoostedTrees:
    """Complete binary trees: the children of node i are 2i+1 and 2i+2; ``leaf`` holds the last level.

    A row goes to the right child if its feature is above the threshold. A node that was not
    split has an infinite threshold, so that all rows go left.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node[0] < inner if len(x) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each feature at most ``bins - 1`` cuts, halfway between neighbouring values."""
    edges = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
        edges.append((values[:-1] + values[1:]) / 2)
    return edges


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 120,
    depth: int = 4,
    rate: float = 0.1,
    bins: int = 64,
    penalty: float = 2.0,
    least_weight: float = 0.5,
) -> BoostedTrees:
    """Trees for the logistic loss, grown level by level from histograms of first and second derivatives.

    ``least_weight`` is the least sum of second derivatives in a leaf. Without rows, or with rows
    of one class only, the result is a constant near that class's share.
    """
    inner = (1 << depth) - 1
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return BoostedTrees(base, feature[:0], threshold[:0], leaf[:0])
    edges = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    width = max(len(e) for e in edges) + 1
    margin = np.full(len(y), base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        first, second = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            count, start = 1 << level, (1 << level) - 1
            best = np.full(count, 1e-9)
            chosen = np.zeros(count, dtype=np.int64)
            cut = np.full(count, -1, dtype=np.int64)
            for f, column in enumerate(binned):
                if not len(edges[f]):
                    continue
                at = (node - start) * width + column
                g = np.bincount(at, first, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(at, second, count * width).reshape(count, width).cumsum(1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                gain[(hl < least_weight) | (ht - hl < least_weight)] = -1
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                better = (value > best) & (top < len(edges[f]))
                best[better], chosen[better], cut[better] = value[better], f, top[better]
            feature[tree, start : start + count] = chosen
            for i in np.flatnonzero(cut >= 0):
                threshold[tree, start + i] = edges[chosen[i]][cut[i]]
            own = node - start
            limit = np.where(cut[own] >= 0, cut[own], width)
            node = 2 * node + 1 + (binned[chosen[own], np.arange(len(y))] > limit)
        own = node - inner
        g, h = np.bincount(own, first, inner + 1), np.bincount(own, second, inner + 1)
        leaf[tree] = rate * g / (h + penalty)
        margin += leaf[tree][own]
    return BoostedTrees(base, feature, threshold, leaf)
