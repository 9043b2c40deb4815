"""Small gradient-boosted trees on binned features, and the calibration of their scores."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Binary classifier: logistic loss, trees of a fixed depth over quantile bins, Newton leaf values. Deterministic."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 2.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        qs = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], qs)) for j in range(x.shape[1])]
        b = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            tree, leaf = self._grow(b, grad, hess)
            self.trees.append(tree)
            score = score + self.rate * tree[2][leaf]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1).astype(np.int64)

    def _grow(self, b: np.ndarray, grad: np.ndarray, hess: np.ndarray):
        """A complete tree: ``(feature of each inner node, its bin, value of each leaf)``; feature -1 sends all rows left."""
        n, m = b.shape
        node = np.zeros(n, np.int64)
        feature, at = np.full(2**self.depth - 1, -1), np.zeros(2**self.depth - 1, np.int64)
        for level in range(self.depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for j in range(m):
                size = self.bins + 1
                k = node * size + b[:, j]
                g = np.bincount(k, grad, width * size).reshape(width, size)
                h = np.bincount(k, hess, width * size).reshape(width, size)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gr, hr = gt - gl, ht - hl
                gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - gt**2 / (ht + self.ridge)
                gain[(hl < self.least * 0.05) | (hr < self.least * 0.05)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best = np.where(better, gain[np.arange(width), top], best)
                feature[first : first + width] = np.where(better, j, feature[first : first + width])
                at[first : first + width] = np.where(better, top, at[first : first + width])
            f = feature[first + node]
            right = (f >= 0) & (b[np.arange(n), np.maximum(f, 0)] > at[first + node])
            node = node * 2 + right
        leaves = 2**self.depth
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        return (feature, at, g / (h + self.ridge)), node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        b = self._binned(x)
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, at, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                i = 2**level - 1 + node
                f = feature[i]
                node = node * 2 + ((f >= 0) & (b[rows, np.maximum(f, 0)] > at[i]))
            total += self.rate * value[node]
        return total


def platt(score: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 0.05) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities on a holdout (logistic regression with a weak pull towards slope 1)."""
    w = np.array([1.0, 0.0])
    x = np.stack([score, np.ones(len(score))], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * (w - np.array([1.0, 0.0])) * len(y)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * (ridge * len(y) + 1e-6)
        w = w - np.linalg.solve(hess, grad)
    return float(max(w[0], 1e-3)), float(w[1])
