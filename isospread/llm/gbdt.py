"""Gradient-boosted trees with logistic loss on binned features: small, and trained on the driver
on a bounded sample."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Trees of a fixed depth, each fitted to the gradient of the ones before."""

    def __init__(
        self, n_trees: int = 50, depth: int = 5, rate: float = 0.35, least: float = 2.0, part=0.35
    ):
        self.n_trees, self.depth, self.rate, self.least, self.part = n_trees, depth, rate, least, part

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T)])
        mean = np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        self.features, self.bins, self.leaves = [], [], []
        margin = np.full(len(y), self.start)
        draw = np.random.default_rng(5)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-margin))
            used = draw.permutation(len(binned))[: max(1, int(self.part * len(binned)))]
            margin += self._grow(binned, used, weight * (y - p), weight * p * (1 - p))
        return self

    def _grow(self, binned: np.ndarray, used, gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
        size = 1 << self.depth
        features = np.zeros(size - 1, dtype=np.int64)
        bins = np.full(size - 1, BINS, dtype=np.int64)
        node = np.zeros(binned.shape[1], dtype=np.int64)
        for level in range(self.depth):
            width = 1 << level
            best = np.full(width, 1e-6)
            at = node - (width - 1)
            for f in used:
                column = binned[f]
                cell = at * BINS + column
                g = np.bincount(cell, weights=gradient, minlength=width * BINS).reshape(width, BINS)
                h = np.bincount(cell, weights=hessian, minlength=width * BINS).reshape(width, BINS)
                gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < self.least) | (ht - hl < self.least)] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best
                where = np.flatnonzero(better) + width - 1
                features[where], bins[where] = f, top[better]
                best[better] = value[better]
            node = 2 * node + 1 + (binned[features[node], np.arange(len(node))] > bins[node])
        leaf = node - (size - 1)
        value = np.bincount(leaf, weights=gradient, minlength=size) / (
            np.bincount(leaf, weights=hessian, minlength=size) + 1
        )
        self.features.append(features)
        self.bins.append(bins)
        self.leaves.append(self.rate * value)
        return self.rate * value[leaf]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        binned = np.stack(
            [np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T)]
        )
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        for features, bins, leaves in zip(self.features, self.bins, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[features[node], rows] > bins[node])
            out += leaves[node - (len(leaves) - 1)]
        return out
