"""Gradient-boosted trees in numpy: grown on binned features, kept as flat node arrays, monotonic where asked."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete node arrays of all trees: children of a leaf are the leaf itself, so a walk of ``depth`` steps always ends in a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``: all trees walk down together, a level at a time."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), self.base)
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def constant(share: float) -> Forest:
    """A model that gives every row the same probability."""
    none, p = np.zeros(0, int), min(max(share, 1e-6), 1 - 1e-6)
    return Forest(none, np.zeros(0), none, none, np.zeros(0), none, 0, float(np.log(p / (1 - p))))


def boost(
    x: np.ndarray,
    y: np.ndarray,
    monotone: Sequence[int],
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 10,
    ridge: float = 1.0,
) -> Forest:
    """Boosted trees for the log-odds of ``y`` (0 or 1).

    ``monotone`` has +1, -1 or 0 for each feature: the score may only rise, only fall, or go either way with it. A split that breaks
    this is not taken, and both sides are held to bounds that meet at the middle of the two values, so deeper splits keep it as well.
    """
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    margin = np.full(len(y), base)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        at = len(feature)
        for column, first in ((feature, 0), (cut, 0.0), (left, at), (right, at), (value, 0.0)):
            column.append(first)
        return at

    def best_split(rows, g, h, low, high):
        found = (1e-6, None)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        whole = total_g**2 / (total_h + ridge)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
            gr, hr = total_g - gl, total_h - hl
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
            fit = (nl >= least) & (len(rows) - nl >= least)
            if monotone[f]:
                fit &= monotone[f] * (vr - vl) >= 0
            gain = np.where(fit, gain, -1.0)
            k = int(gain.argmax())
            if gain[k] > found[0]:
                found = (gain[k], (f, k, vl[k], vr[k]))
        return found[1]

    for _ in range(trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        root = node()
        roots.append(root)
        todo = [(root, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, level, low, high = todo.pop()
            split = best_split(rows, g, h, low, high) if level < depth and len(rows) >= 2 * least else None
            if split is None:
                value[at] = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
                margin[rows] += value[at]
                continue
            f, k, vl, vr = split
            feature[at], cut[at] = f, float(edges[f][k])
            left[at], right[at] = node(), node()
            goes = binned[rows, f] <= k
            middle = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[f]]
            for child, part, (a, b) in ((left[at], rows[goes], bounds[0]), (right[at], rows[~goes], bounds[1])):
                todo.append((child, part, level + 1, a, b))
    arrays = [np.array(c) for c in (feature, cut, left, right, value, roots)]
    return Forest(*arrays, depth, base)
