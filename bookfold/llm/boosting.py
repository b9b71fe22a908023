"""Small gradient-boosted trees with monotonic constraints, flattened into node arrays for vectorised scoring.

Training is meant for a bounded sample of labelled rows on one machine; scoring walks all rows one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BINS = 64


@dataclass(frozen=True)
class BoostedTrees:
    """Node arrays of all trees: ``feature`` is -1 in leaves; ``left``/``right`` are node numbers; ``roots`` one per tree."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while (inner := self.feature[node] >= 0).any():
                at = node[inner]
                goes_left = x[row[inner], self.feature[at]] <= self.threshold[at]
                node[inner] = np.where(goes_left, self.left[at], self.right[at])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


class _Grower:
    """Grows trees on binned features into shared node lists."""

    def __init__(self, edges: list[np.ndarray], signs: np.ndarray, depth: int, least_rows: int, penalty: float):
        self.edges, self.signs, self.depth, self.least_rows, self.penalty = edges, signs, depth, least_rows, penalty
        self.nodes: list[list[float]] = []

    def leaf(self, value: float) -> int:
        self.nodes.append([-1, 0.0, 0, 0, value])
        return len(self.nodes) - 1

    def grow(self, codes: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, level: int, low: float, high: float) -> int:
        weight = lambda g, h: np.clip(-g / (h + self.penalty), low, high)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = None
        if level < self.depth and len(rows) >= 2 * self.least_rows:
            for f, edges in enumerate(self.edges):
                if not len(edges):
                    continue
                code = codes[rows, f]
                gl = np.cumsum(np.bincount(code, gradient[rows], len(edges) + 1))[:-1]
                hl = np.cumsum(np.bincount(code, hessian[rows], len(edges) + 1))[:-1]
                nl = np.cumsum(np.bincount(code, minlength=len(edges) + 1))[:-1]
                wl, wr = weight(gl, hl), weight(g - gl, h - hl)
                # The loss of a constrained weight w is g w + (h + penalty) w^2 / 2.
                loss = gl * wl + (hl + self.penalty) * wl**2 / 2 + (g - gl) * wr + (h - hl + self.penalty) * wr**2 / 2
                allowed = (nl >= self.least_rows) & (len(rows) - nl >= self.least_rows) & (self.signs[f] * (wr - wl) >= 0)
                if allowed.any():
                    loss = np.where(allowed, loss, np.inf)
                    at = int(np.argmin(loss))
                    if best is None or loss[at] < best[0] - 1e-12:
                        best = (loss[at], f, at, wl[at], wr[at])
        own = float(weight(g, h))
        if best is None or best[0] >= g * own + (h + self.penalty) * own**2 / 2 - 1e-9:
            return self.leaf(own)
        _, f, at, wl, wr = best
        here = self.leaf(0.0)
        goes_left = codes[rows, f] <= at
        # Below a constrained split, the left side's weights stay on their side of the middle, the right side's on theirs.
        middle = (wl + wr) / 2
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[int(self.signs[f])]
        left = self.grow(codes, gradient, hessian, rows[goes_left], level + 1, *bounds[0])
        right = self.grow(codes, gradient, hessian, rows[~goes_left], level + 1, *bounds[1])
        self.nodes[here] = [f, float(self.edges[f][at]), left, right, 0.0]
        return here


def train_boosted_trees(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, least_rows: int = 8, penalty: float = 1.0) -> BoostedTrees:
    """Logistic loss. ``signs``: for each feature 1 (never falling), -1 (never rising) or 0."""
    share = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, _BINS + 1)[1:-1], method="lower")) for column in x.T]
    codes = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    grower = _Grower(edges, np.array(signs), depth, least_rows, penalty)
    margin, rows, roots = np.full(len(x), base), np.arange(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        first = len(grower.nodes)
        roots.append(grower.grow(codes, p - y, p * (1 - p), rows, 0, -np.inf, np.inf))
        for node in grower.nodes[first:]:
            node[4] *= rate
        margin += _flat(grower.nodes, 0.0, roots[-1:]).margin(x)
    return _flat(grower.nodes, base, roots)


def _flat(nodes: list[list[float]], base: float, roots: list[int]) -> BoostedTrees:
    table = np.array(nodes, np.float64)
    whole = table[:, [0, 2, 3]].astype(np.int32)
    return BoostedTrees(base, np.array(roots), whole[:, 0], table[:, 1], whole[:, 1], whole[:, 2], table[:, 4])
