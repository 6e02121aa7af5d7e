"""Histogram gradient-boosted trees for a bounded sample, flattened for numpy.

Features are cut into quantile bins; a level of a tree is found from one
histogram of gradients over (node, feature, bin). Trees are complete, so a model
is three arrays (feature, threshold, leaf) and scoring is one indexing step a
level for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """``feature`` and ``threshold`` by tree and inner node, ``leaf`` by tree and leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - len(feature)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, smooth: float = 1.0, least: int = 8
) -> Trees:
    """Trees for the logistic loss. Without rows, or with one label only, the share of label 1 (smoothed)."""
    n, width = x.shape
    prior = (y.sum() + 1.0) / (n + 2.0) if n else 0.5
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = 2**depth - 1, 2**depth
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    cells = binned + np.arange(width) * BINS
    margin = np.full(n, base)
    out_feature, out_threshold, out_leaf = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)  # nothing is larger: all rows go left
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            where = ((at - first)[:, None] * (width * BINS) + cells).ravel()
            shape = (nodes, width, BINS)
            size = nodes * width * BINS
            g = np.bincount(where, np.repeat(gradient, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(where, np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            c = np.bincount(where, minlength=size).reshape(shape).cumsum(axis=2)
            whole = g[:, :, -1:] ** 2 / (h[:, :, -1:] + smooth)
            gain = g**2 / (h + smooth) + (g[:, :, -1:] - g) ** 2 / (h[:, :, -1:] - h + smooth) - whole
            gain[(c < least) | (c[:, :, -1:] - c < least)] = 0
            flat = gain.reshape(nodes, -1)
            best = flat.argmax(axis=1)
            for node in np.flatnonzero(flat[np.arange(nodes), best] > 1e-9):
                f, b = divmod(int(best[node]), BINS)
                feature[first + node], threshold[first + node] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        g = np.bincount(at - inner, gradient, leaves)
        h = np.bincount(at - inner, weight, leaves)
        leaf = -rate * g / (h + smooth)
        margin += leaf[at - inner]
        out_feature.append(feature)
        out_threshold.append(threshold)
        out_leaf.append(leaf)
    return Trees(base, np.array(out_feature), np.array(out_threshold), np.array(out_leaf))
