"""Gradient boosted regression trees for a few thousand rows, and their evaluation as one SQL expression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 40
DEPTH = 3
RATE = 0.2
LEAST_LEAF = 8
CUTS = 16


class Boosted:
    """Logistic loss; splits at quantiles of each feature; leaves by one Newton step."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share / (1 - share)))
        self.trees: list[tuple] = []
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[:-1])) for f in range(x.shape[1])]
        z = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(x, p - y, p * (1 - p), np.arange(len(y)), DEPTH)
            if tree[0] == "leaf":
                break
            self.trees.append(tree)
            z += self._values(tree, x)

    def _grow(self, x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int) -> tuple:
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf = ("leaf", float(-RATE * g / (h + 1)))
        if not depth or len(rows) < 2 * LEAST_LEAF:
            return leaf
        best: tuple[float, int, float] | None = None
        for f, cuts in enumerate(self.cuts):
            values = x[rows, f]
            for cut in cuts:
                left = values <= cut
                n = int(left.sum())
                if n < LEAST_LEAF or len(rows) - n < LEAST_LEAF:
                    continue
                gl, hl = grad[rows][left].sum(), hess[rows][left].sum()
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > 1e-6 and (best is None or gain > best[0]):
                    best = (float(gain), f, float(cut))
        if best is None:
            return leaf
        left = x[rows, best[1]] <= best[2]
        return ("split", best[1], best[2], self._grow(x, grad, hess, rows[left], depth - 1), self._grow(x, grad, hess, rows[~left], depth - 1))

    def _values(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        if tree[0] == "leaf":
            return np.full(len(x), tree[1])
        _, f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._values(low, x), self._values(high, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for tree in self.trees:
            z = z + self._values(tree, x)
        return 1 / (1 + np.exp(-z))

    def column(self, features: list[Column]) -> Column:
        """The probability as nested conditionals."""

        def of(tree: tuple) -> Column:
            if tree[0] == "leaf":
                return F.lit(tree[1])
            _, f, cut, low, high = tree
            return F.when(features[f] <= cut, of(low)).otherwise(of(high))

        z = F.lit(self.start)
        for tree in self.trees:
            z = z + of(tree)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
