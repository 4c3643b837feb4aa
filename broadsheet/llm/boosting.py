"""Gradient-boosted trees in numpy, for small tables of features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 16


@dataclass
class Node:
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None
    value: float = 0.0


@dataclass
class Forest:
    base: float
    trees: list[Node]
    slope: float = 1.0  # calibration of the summed trees
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            _add(tree, x, np.arange(len(x)), out)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))


def _add(node: Node, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    if node.left is None or node.right is None:
        out[rows] += node.value
        return
    low = x[rows, node.feature] <= node.limit
    _add(node.left, x, rows[low], out)
    _add(node.right, x, rows[~low], out)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, rate: float, ridge: float) -> Node:
    total_g, total_h = g[rows].sum(), h[rows].sum()
    node = Node(value=-rate * total_g / (total_h + ridge))
    if depth == 0 or len(rows) < 10:
        return node
    best = 1e-6
    for feature in range(x.shape[1]):
        v = x[rows, feature]
        for limit in np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")):
            low = v <= limit
            if low.all():
                continue
            gl, hl = g[rows][low].sum(), h[rows][low].sum()
            gain = gl**2 / (hl + ridge) + (total_g - gl) ** 2 / (total_h - hl + ridge) - total_g**2 / (total_h + ridge)
            if gain > best:
                best, node.feature, node.limit = gain, feature, float(limit)
    if node.feature >= 0:
        low = x[rows, node.feature] <= node.limit
        node.left = _grow(x, g, h, rows[low], depth - 1, rate, ridge)
        node.right = _grow(x, g, h, rows[~low], depth - 1, rate, ridge)
    return node


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Forest:
    """Logistic loss, second-order leaf values."""
    forest = Forest(float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), [])
    score = np.full(len(y), forest.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, p - y, p * (1 - p), np.arange(len(y)), depth, rate, ridge)
        _add(tree, x, np.arange(len(y)), score)
        forest.trees.append(tree)
    return forest


def calibrate(forest: Forest, x: np.ndarray, y: np.ndarray) -> Forest:
    """Fit slope and shift of the summed trees on rows that were not boosted on."""
    raw, a, b = forest.raw(x), 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * raw).sum() + 0.01 * (a - 1), (p - y).sum() + 0.01 * b])
        h = np.array([[(w * raw * raw).sum() + 0.01, (w * raw).sum()], [(w * raw).sum(), w.sum() + 0.01]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g).clip(-1, 1)
    forest.slope, forest.shift = max(float(a), 1e-3), float(b)
    return forest


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """A probability from which on the rows reach ``precision``; above 1 if none does.

    It lies halfway to the next row that would break it, for rows not seen yet.
    """
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    # Only at the last of equal probabilities is the cut a real one.
    last = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last)
    if not len(good):
        return 1.1
    at = good[-1]
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)
