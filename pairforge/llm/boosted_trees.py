"""Gradient-boosted trees on binned features, kept as flat numpy arrays of nodes.

A tree grows level by level from sums of gradients per node, feature and bin. The sums are
whole numbers, so they are the same however the rows are dealt over parts (``Part``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Cut points of a feature at most, plus one; a bin takes one byte.
BINS = 64
#: Gradients are summed in whole multiples of 2 ** -32; a part of up to 2 ** 20 rows sums them without loss.
SCALE = float(1 << 32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Trees:
    """All nodes of all trees in a row. A leaf points to itself, so every row takes ``depth`` steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def leaf_of(self, x: np.ndarray, root: int) -> np.ndarray:
        """The leaf of one tree that each row of ``x`` falls into."""
        rows, at = np.arange(len(x)), np.full(len(x), root)
        for _ in range(self.depth):
            go_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return at

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of ``x``."""
        total = np.full(len(x), self.base)
        for root in self.roots:
            total += self.value[self.leaf_of(x, root)]
        return total


@dataclass
class Part:
    """Some rows to be fitted on: the bins of their features, their labels and their margin by the first ``done`` trees."""

    binned: np.ndarray
    y: np.ndarray
    margin: np.ndarray
    done: int = 0

    def advance(self, grown: Trees, done: int) -> None:
        """Take in trees, whose thresholds are bins, up to a number of them."""
        for root in grown.roots[self.done : done]:
            self.margin += grown.value[grown.leaf_of(self.binned, root)]
        self.done = done

    def sums(self, grown: Trees, nodes: list[int]) -> np.ndarray:
        """Gradients, Hessians and rows in each of ``nodes`` of the last tree, by feature and bin."""
        self.advance(grown, len(grown.roots) - 1)
        slot = np.full(len(grown.value), -1)
        slot[nodes] = np.arange(len(nodes))
        at = slot[grown.leaf_of(self.binned, grown.roots[-1])]
        own = at >= 0
        p = sigmoid(self.margin[own])
        grad = np.rint((p - self.y[own]) * SCALE)
        hess = np.rint(np.maximum(p * (1 - p), 1e-6) * SCALE)
        features = self.binned.shape[1]
        out = np.zeros((3, len(nodes), features, BINS), np.int64)
        for j in range(features):
            key = at[own] * BINS + self.binned[own, j]
            for k, weights in enumerate((grad, hess, None)):
                out[k, :, j] = np.bincount(key, weights, len(nodes) * BINS).reshape(len(nodes), BINS)
        return out


def cut_places(n: int, bins: int = BINS) -> np.ndarray:
    """Places of the cut points in a sorted column of ``n`` values."""
    return np.floor((n - 1) * np.linspace(0, 1, bins + 1)[1:-1]).astype(np.int64)


def bins_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


def base_margin(share: float) -> float:
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    return float(np.log(share / (1 - share)))


def boost(
    sums: Callable[[Trees, list[int]], np.ndarray],
    edges: list[np.ndarray],
    base: float,
    monotone: np.ndarray,
    *,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    l2: float = 5.0,
    min_rows: int = 10,
) -> Trees:
    """Boost trees on the logistic loss; ``sums`` adds up ``Part.sums`` over all rows.

    ``monotone`` has per feature 1 (the score may only rise with it), -1 (only
    fall) or 0. A split against the constraint is not taken, and the mean of the
    two leaves of a constrained split bounds everything below it, so that the
    whole model is monotone in the feature.
    """
    feature, threshold, cut, left, right, value, roots = [], [], [], [], [], [], []

    def leaf(v: float = 0.0) -> int:
        feature.append(0)
        threshold.append(np.inf)
        cut.append(np.inf)
        left.append(len(value))
        right.append(len(value))
        value.append(v)
        return len(value) - 1

    def grown(by: list[float]) -> Trees:
        arrays = (np.array(x) for x in (roots, feature, by, left, right, value))
        return Trees(*arrays, depth, base)

    def split(own: np.ndarray, low: float, high: float, weight: float) -> tuple | None:
        """The best feature and bin, and per side the gradient, the Hessian, the rows and the bounds."""
        (g, h), n = own[:2, 0].sum(-1) / SCALE, own[2, 0].sum()
        best, gain = None, 1e-6
        for j, e in enumerate(edges):
            if not len(e):
                continue
            gl, hl = np.cumsum(own[:2, j], axis=-1)[:, : len(e)] / SCALE
            nl = np.cumsum(own[2, j])[: len(e)]
            wl = np.clip(-gl / (hl + l2), low, high)
            wr = np.clip(-(g - gl) / (h - hl + l2), low, high)
            # What the loss falls by with these (clipped) leaf weights.
            score = -(gl * wl + 0.5 * (hl + l2) * wl**2) - ((g - gl) * wr + 0.5 * (h - hl + l2) * wr**2)
            score += g * weight + 0.5 * (h + l2) * weight**2
            allowed = (nl >= min_rows) & (n - nl >= min_rows) & (monotone[j] * (wr - wl) >= 0)
            score = np.where(allowed, score, -np.inf)
            k = int(score.argmax())
            if score[k] > gain:
                gain, mid = float(score[k]), float(wl[k] + wr[k]) / 2
                bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[int(monotone[j])]
                best = j, k, (gl[k], hl[k], nl[k], *bounds[0]), (g - gl[k], h - hl[k], n - nl[k], *bounds[1])
        return best

    def weigh(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + l2), low, high))

    for _ in range(rounds):
        roots.append(leaf())
        level = [(roots[-1], -np.inf, np.inf)]
        for _ in range(depth):
            if not level:
                break
            found = sums(grown(cut), [node for node, _, _ in level])
            below = []
            for i, (node, low, high) in enumerate(level):
                own = found[:, i]
                weight = weigh(*own[:2, 0].sum(-1) / SCALE, low, high)
                value[node] = weight * rate
                best = split(own, low, high, weight) if own[2, 0].sum() >= 2 * min_rows else None
                if best is None:
                    continue
                j, k, *sides = best
                feature[node], threshold[node], cut[node] = j, float(edges[j][k]), float(k)
                ends = [leaf(weigh(g, h, *bounds) * rate) for g, h, _, *bounds in sides]
                left[node], right[node] = ends
                below += [(end, *bounds) for end, (_, _, n, *bounds) in zip(ends, sides, strict=True) if n >= 2 * min_rows]
            level = below
    return grown(threshold)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, *, bins: int = BINS, **options) -> Trees:
    """Boost trees over rows that are in memory."""
    places = cut_places(len(x), bins)
    edges = [np.unique(np.sort(x[:, j])[places]) for j in range(x.shape[1])]
    base = base_margin(float(y.mean()))
    part = Part(bins_of(x, edges), y, np.full(len(y), base))
    return boost(part.sums, edges, base, monotone, **options)
