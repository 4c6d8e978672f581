"""Small gradient-boosted trees and isotonic calibration in numpy.

Fitted on the driver on a bounded table of training rows (the callers state
the bound); scored either in numpy inside tasks or as a Spark expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Boosted:
    """Logistic boosting of shallow trees over binned features (Newton steps)."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 2.0, least: float = 4.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least
        self.trees: list = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Boosted:
        """``x`` rows by features; ``y`` share of positives; ``w`` row weights."""
        w = np.ones(len(x)) if w is None else w.astype(float)
        self.edges = [self._edges(x[:, j]) for j in range(x.shape[1])]
        b = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)
        p = np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        z = np.full(len(x), self.base)
        for _ in range(self.rounds):
            q = _sigmoid(z)
            g, h = w * (y - q), w * q * (1 - q)
            tree = self._grow(b, g, h, w, np.arange(len(x)), self.depth)
            self.trees.append(tree)
            z += self._apply(tree, x)
        return self

    def _edges(self, v: np.ndarray) -> np.ndarray:
        u = np.unique(v)
        if len(u) > self.bins:
            u = np.unique(np.quantile(v, np.linspace(0, 1, self.bins + 1)[1:-1]))
            return u
        return u[:-1]  # a value goes left of an edge if it is at most the edge

    def _grow(self, b, g, h, w, at, depth):
        best = (1e-6, None, None)
        gs, hs = g[at].sum(), h[at].sum()
        if depth and len(at) > 1:
            for j, e in enumerate(self.edges):
                if not len(e):
                    continue
                n = len(e) + 1
                gj, hj, wj = (np.cumsum(np.bincount(b[at, j], v[at], n))[:-1] for v in (g, h, w))
                gain = gj**2 / (hj + self.l2) + (gs - gj) ** 2 / (hs - hj + self.l2) - gs**2 / (hs + self.l2)
                gain[(wj < self.least) | (w[at].sum() - wj < self.least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-12:
                    best = (float(gain[k]), j, k)
        if best[1] is None:
            return float(self.rate * gs / (hs + self.l2))
        _, j, k = best
        left = b[at, j] <= k
        return (j, float(self.edges[j][k]), self._grow(b, g, h, w, at[left], depth - 1), self._grow(b, g, h, w, at[~left], depth - 1))

    def _apply(self, tree, x):
        if isinstance(tree, float):
            return np.full(len(x), tree)
        j, t, a, c = tree
        return np.where(x[:, j] <= t, self._apply(a, x), self._apply(c, x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for t in self.trees:
            z += self._apply(t, x)
        return z

    def column(self, features: list[Column]) -> Column:
        """The raw score as a Spark expression."""

        def walk(tree):
            if isinstance(tree, float):
                return F.lit(tree)
            j, t, a, c = tree
            return F.when(features[j] <= t, walk(a)).otherwise(walk(c))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + walk(t)
        return out


class Isotonic:
    """Calibration by pool-adjacent-violators; between pooled scores the value
    is interpolated, so the order of scores is kept."""

    def __init__(self, z: np.ndarray, y: np.ndarray, w: np.ndarray | None = None):
        w = np.ones(len(z)) if w is None else w.astype(float)
        order = np.argsort(z, kind="stable")
        pools: list[list[float]] = []  # weighted score, weighted label, weight
        for a, b, c in zip(z[order], y[order], w[order], strict=True):
            pools.append([a * c, b * c, c])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [u + v for u, v in zip(pools[-1], last, strict=True)]
        self.x = np.array([p[0] / p[2] for p in pools] or [0.0])
        self.y = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools] or [0.5])  # off 0 and 1
        self.y = np.maximum.accumulate(self.y)

    def __call__(self, z: np.ndarray) -> np.ndarray:
        """Calibrated probability; the slight slope of the raw score breaks ties within a pool."""
        p = np.interp(z, self.x, self.y)
        return np.clip(p * 0.998 + 0.002 * _sigmoid(z), 0, 1)

    def least_score(self, p: float) -> float:
        """The lowest raw score at which the calibrated value reaches ``p`` (infinite if none does)."""
        if self.y[-1] < p:
            return float("inf")
        k = int(np.argmax(self.y >= p))
        if k == 0:
            return float(self.x[0])
        a, b = self.y[k - 1], self.y[k]
        return float(self.x[k - 1] + (self.x[k] - self.x[k - 1]) * (p - a) / (b - a))
