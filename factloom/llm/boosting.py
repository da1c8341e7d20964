"""Gradient-boosted trees for two classes, by histograms in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: feature, threshold (go right above it) and leaf values of each tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def keep(self, first: int) -> np.ndarray:
        """The features from ``first`` on that are used; the trees then take these alone, in this order, after the first ones."""
        used = np.unique(self.feature[self.feature >= first])
        self.feature = np.where(self.feature < first, self.feature, first + np.searchsorted(used, self.feature))
        return used

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(v)))):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (len(v) - 1)]
        return out


def _gain(left: np.ndarray, total: np.ndarray, shrink: float) -> np.ndarray:
    """Gain of putting the sums ``left`` (gradient, curvature) of some of a node's rows apart from the rest of its ``total``."""
    score = lambda v: v[0] ** 2 / (v[1] + shrink)
    return score(left) + score(total - left) - score(total)


def fit(x: np.ndarray, flags: tuple[np.ndarray, np.ndarray], y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 24, shrink: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss over numbers ``x`` and 0/1 flags (row and number of each set one), whose features follow those of x.

    Histograms of a level's nodes are summed together.
    """
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    n, m, width = len(y), x.shape[1], max(len(c) for c in cuts) + 1
    flat = (np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)]) + np.arange(m) * width).ravel()
    of_row, flag = flags
    k = int(flag.max(initial=0)) + 1
    has = np.zeros((n, k), bool)
    has[of_row, flag] = True
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    z = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-z))
        gh = np.stack([y - q, q * (1 - q)])
        f, t = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            at = node - first
            sums = lambda index, weights, size: np.bincount(index, weights=weights, minlength=nodes * size).reshape(nodes, size)  # noqa: B023, E731
            total = np.stack([sums(at, v, 1) for v in gh])
            index = np.repeat(at * (m * width), m) + flat
            by_bin = np.stack([np.cumsum(sums(index, np.repeat(v, m), m * width).reshape(nodes, m, width), axis=2).reshape(nodes, -1) for v in gh])
            set_ = np.stack([sums(at[of_row] * k + flag, v[of_row], k) for v in gh])
            gain = np.concatenate([_gain(by_bin, total, shrink), _gain(total - set_, total, shrink)], axis=1)
            best = gain.argmax(axis=1)
            for i in np.flatnonzero((np.bincount(at, minlength=nodes) >= 20) & (gain[np.arange(nodes), best] > 1e-6)):
                j = first + i
                if best[i] >= m * width:
                    f[j], t[j] = m + best[i] - m * width, 0.5
                else:
                    f[j], b = divmod(int(best[i]), width)
                    t[j] = cuts[f[j]][b] if b < len(cuts[f[j]]) else np.inf
            rows, of = np.arange(n), f[node]
            value = np.where(of < m, x[rows, np.minimum(of, m - 1)], has[rows, np.maximum(of - m, 0)])
            node = 2 * node + 1 + (value > t[node])
        at = node - (2**depth - 1)
        g, h = (np.bincount(at, weights=v, minlength=2**depth) for v in gh)
        v = rate * g / (h + shrink)
        z += v[at]
        features.append(f)
        thresholds.append(t)
        leaves.append(v)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))
