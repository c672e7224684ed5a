"""Gradient-boosted trees on histograms, kept as flat arrays.

All trees have the same depth, so a tree is three rows of arrays: the feature and the
threshold of each inner node, and the value of each leaf. Scoring walks all rows and all
trees down together, one numpy step for each level.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # go right if the value is larger
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        count, inner = self.feature.shape
        trees = np.arange(count)[None, :]
        node = np.zeros((len(x), count), np.int64)
        rows = np.arange(len(x))[:, None]
        while count and len(x) and node[0, 0] < inner:
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        margin = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    smooth: float = 1.0,
    least: int = 20,
) -> Trees:
    """Fit logistic loss by Newton steps; splits are chosen from histograms of `bins` bins.

    Without rows, or with one label only, the score is the smoothed share of label 1.
    """
    inner, leaves = 2**depth - 1, 2**depth
    ones = float(y.sum())
    base = float(np.log((ones + 0.5) / (len(y) - ones + 0.5)))
    if not 0 < ones < len(y):
        empty = np.zeros((0, inner))
        return Trees(base, empty.astype(np.int64), empty, np.zeros((0, leaves)))
    features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    # Bin b holds values up to cuts[b]; splitting after bin b is x > cuts[b].
    limits = np.full((features, bins), np.inf)
    for f, c in enumerate(cuts):
        limits[f, : len(c)] = c
    margin = np.full(len(y), base)
    out = Trees(
        base,
        np.zeros((trees, inner), np.int64),
        np.full((trees, inner), np.inf),
        np.zeros((trees, leaves)),
    )
    column = np.arange(features) * bins
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = ((node - first)[:, None] * features * bins + column + binned).ravel()
            size = width * features * bins

            def summed(weights: np.ndarray) -> np.ndarray:
                total = np.bincount(place, np.repeat(weights, features), size)
                return total.reshape(width, features, bins).cumsum(axis=2)

            g, h, n = summed(grad), summed(hess), summed(np.ones(len(y)))
            all_g, all_h, all_n = g[:, :, -1:], h[:, :, -1:], n[:, :, -1:]
            gain = (
                g**2 / (h + smooth)
                + (all_g - g) ** 2 / (all_h - h + smooth)
                - all_g**2 / (all_h + smooth)
            )
            gain[(n < least) | (all_n - n < least) | ~np.isfinite(limits)[None]] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            useful = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            feature, cut = best // bins, best % bins
            out.feature[tree, first : first + width] = feature
            out.threshold[tree, first : first + width] = np.where(
                useful, limits[feature, cut], np.inf
            )
            own = node - first
            right = x[np.arange(len(y)), feature[own]] > out.threshold[tree, node]
            node = 2 * node + 1 + right
        own = node - inner
        step = rate * np.bincount(own, grad, leaves) / (np.bincount(own, hess, leaves) + smooth)
        out.leaf[tree] = step
        margin += step[own]
    return out
