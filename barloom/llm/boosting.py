"""Gradient-boosted trees of depth two over counted feature rows, scored as SQL expressions."""

import math

import numpy as np
from pyspark.sql import functions as F

ROUNDS, RATE, RIDGE = 40, 0.3, 1.0


class Trees:
    """Logistic loss. A tree is a number or (feature, limit, low, high): low where value <= limit."""

    def __init__(self, rows, rounds=ROUNDS, rate=RATE):
        """``rows``: (features, count, positives) with small integer features from 0, one per distinct row."""
        values = np.array([f for f, _, _ in rows], np.int64)
        counts, positives = (np.array([r[i] for r in rows], float) for i in (1, 2))
        self.base = math.log((positives.sum() + 1) / (counts.sum() - positives.sum() + 1))
        self.trees = []
        margins = np.full(len(rows), self.base)
        for _ in range(rounds):
            chance = 1 / (1 + np.exp(-margins))
            tree, steps = self._grow(values, counts * chance - positives, counts * chance * (1 - chance), 2, rate)
            self.trees.append(tree)
            margins += steps

    def _grow(self, values, slopes, curves, depth, rate):
        """A tree for the rows, and what it adds to the margin of each."""
        g, h = slopes.sum(), curves.sum()
        best, found = 1e-9, None
        for feature in range(values.shape[1]) if depth and len(values) else []:
            own = values[:, feature]
            present = np.flatnonzero(np.bincount(own))[:-1]
            left_g, left_h = (np.cumsum(np.bincount(own, w))[present] for w in (slopes, curves))
            gains = left_g ** 2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g ** 2 / (h + RIDGE)
            if len(gains) and gains.max() > best:
                best, found = float(gains.max()), (feature, int(present[gains.argmax()]))
        if found is None:
            leaf = float(-rate * g / (h + RIDGE))
            return leaf, np.full(len(values), leaf)
        low = values[:, found[0]] <= found[1]
        steps, sides = np.empty(len(values)), []
        for side in (low, ~low):
            tree, steps[side] = self._grow(values[side], slopes[side], curves[side], depth - 1, rate)
            sides.append(tree)
        return (*found, *sides), steps

    def used(self) -> set[int]:
        """The features that any tree looks at."""
        def inner(tree):
            return {tree[0]} | inner(tree[2]) | inner(tree[3]) if isinstance(tree, tuple) else set()

        return set().union(*map(inner, self.trees))

    @staticmethod
    def _leaf(tree, features):
        while isinstance(tree, tuple):
            tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
        return tree

    def margin(self, features) -> float:
        return self.base + sum(self._leaf(t, features) for t in self.trees)

    def expression(self, features):
        """The margin as a column over feature columns."""
        def branch(tree):
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(features[tree[0]] <= tree[1], branch(tree[2])).otherwise(branch(tree[3]))

        total = F.lit(self.base)
        for tree in self.trees:
            total = total + branch(tree)
        return total


def calibration(rows, trees: Trees, steps=200, rate=0.5):
    """Slope and offset that turn margins into probabilities (Platt), from held-out rows."""
    slope, offset = 1.0, 0.0
    total = sum(n for _, n, _ in rows) or 1
    margins = [trees.margin(f) for f, _, _ in rows]
    for _ in range(steps):
        by_slope = by_offset = 0.0
        for m, (_, n, p) in zip(margins, rows):
            error = (n / (1 + math.exp(-max(-60, min(60, slope * m + offset)))) - p) / total
            by_slope, by_offset = by_slope + error * m, by_offset + error
        slope, offset = max(0.05, slope - rate * by_slope / 10), offset - rate * by_offset
    return slope, offset
