"""Gradient-boosted regression trees for a yes-or-no question, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """A full binary tree: node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        every = np.arange(len(x))
        for _ in range(self.depth):
            right = x[every, self.feature[node]] > self.limit[node]
            node = 2 * node + 1 + right
        return node


@dataclass(frozen=True)
class Boosted:
    bias: float
    trees: tuple[Tree, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of yes."""
        odds = np.full(len(x), self.bias)
        for tree in self.trees:
            odds += tree.value[tree.leaves(x)]
        return 1 / (1 + np.exp(-odds))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 32,
    penalty: float = 1.0,
) -> Boosted:
    """Logistic boosting; splits lie between quantiles of a feature."""
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(mean / (1 - mean)))
    limits = [
        np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T
    ]
    binned = np.stack(
        [np.searchsorted(limit, column) for limit, column in zip(limits, x.T)], axis=1
    )
    odds, trees = np.full(len(y), bias), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        tree = _grow(binned, limits, y - p, p * (1 - p), depth, rate, penalty)
        odds += tree.value[tree.leaves(x)]
        trees.append(tree)
    return Boosted(bias, tuple(trees))


def _grow(binned, limits, gradient, weight, depth, rate, penalty) -> Tree:
    size = 2 ** (depth + 1) - 1
    feature, value = np.zeros(size, np.int64), np.zeros(size)
    limit = np.full(size, np.inf)
    node = np.zeros(len(gradient), np.int64)
    for parent in range(2**depth - 1):
        (rows,) = np.nonzero(node == parent)
        best = (1e-6, None, None)
        for f, cuts in enumerate(limits):
            if not len(rows) or not len(cuts):
                continue
            n = len(cuts) + 1
            g = np.bincount(binned[rows, f], gradient[rows], n).cumsum()
            h = np.bincount(binned[rows, f], weight[rows], n).cumsum()
            gain = (
                g[:-1] ** 2 / (h[:-1] + penalty)
                + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + penalty)
                - g[-1] ** 2 / (h[-1] + penalty)
            )
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], f, at)
        right = np.zeros(len(rows), bool)
        if best[1] is not None:
            feature[parent], limit[parent] = best[1], limits[best[1]][best[2]]
            right = binned[rows, best[1]] > best[2]
        node[rows] = 2 * parent + 1 + right
    g = np.bincount(node, gradient, size)
    h = np.bincount(node, weight, size)
    value[:] = rate * g / (h + penalty)
    return Tree(feature, limit, value, depth)
