"""Gradient-boosted trees and isotonic calibration in numpy, for a bounded number of rows."""

import numpy as np


class Trees:
    """Logistic boosting of shallow trees over binned columns."""

    def __init__(self, rounds=80, depth=3, rate=0.15, bins=32, least=0.5, ridge=1.0):
        self.rounds, self.depth, self.rate = rounds, depth, rate
        self.bins, self.least, self.ridge = bins, least, ridge
        self.base, self.edges, self.trees = 0.0, [], []

    def _binned(self, rows):
        binned = np.empty(rows.shape, np.int64)
        for i, edges in enumerate(self.edges):
            binned[:, i] = np.searchsorted(edges, rows[:, i], "left")
        return binned

    def fit(self, rows, target):
        rows, target = np.asarray(rows, float), np.asarray(target, float)
        share = np.clip(target.mean() if len(target) else 0.0, 1e-4, 1 - 1e-4)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        steps = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, steps, method="lower")) if len(c) else c
                      for c in rows.T]
        if not len(target) or target.min() == target.max():
            return self
        binned, raw = self._binned(rows), np.full(len(target), self.base)
        for _ in range(self.rounds):
            chance = 1 / (1 + np.exp(-raw))
            tree = self._grow(binned, target - chance, chance * (1 - chance))
            self.trees.append(tree)
            raw += self._leaves(tree, binned)
        return self

    def _grow(self, binned, slope, weight):
        """Columns and bins of the splits, level by level, and the value of every leaf."""
        columns, cuts, node = [], [], np.zeros(len(slope), np.int64)
        width = self.bins + 1
        for level in range(self.depth):
            nodes = 1 << level
            best = np.zeros(nodes)
            column, cut = np.zeros(nodes, np.int64), np.full(nodes, width)
            whole = np.bincount(node, slope, nodes), np.bincount(node, weight, nodes)
            score = whole[0] ** 2 / (whole[1] + self.ridge)
            for i in range(binned.shape[1]):
                at = node * width + binned[:, i]
                g = np.bincount(at, slope, nodes * width).reshape(nodes, width).cumsum(1)
                h = np.bincount(at, weight, nodes * width).reshape(nodes, width).cumsum(1)
                rest = whole[0][:, None] - g, whole[1][:, None] - h
                gain = g * g / (h + self.ridge) + rest[0] ** 2 / (rest[1] + self.ridge)
                gain = np.where((h >= self.least) & (rest[1] >= self.least),
                                gain - score[:, None], 0)
                top = gain.argmax(1)
                value = gain[np.arange(nodes), top]
                better = value > best + 1e-12
                best[better], column[better], cut[better] = value[better], i, top[better]
            columns.append(column)
            cuts.append(cut)
            node = 2 * node + (binned[np.arange(len(node)), column[node]] > cut[node])
        leaves = 1 << self.depth
        value = np.bincount(node, slope, leaves) / (
            np.bincount(node, weight, leaves) + self.ridge
        )
        return columns, cuts, self.rate * value

    @staticmethod
    def _leaves(tree, binned):
        columns, cuts, values = tree
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for column, cut in zip(columns, cuts):
            node = 2 * node + (binned[rows, column[node]] > cut[node])
        return values[node]

    def raw(self, rows):
        """Log odds before calibration."""
        rows = np.asarray(rows, float)
        total = np.full(len(rows), self.base)
        if self.trees:
            binned = self._binned(rows)
            for tree in self.trees:
                total += self._leaves(tree, binned)
        return total


class Isotonic:
    """A rising step function from raw scores to shares, joined by straight lines."""

    def fit(self, raw, target):
        order = np.argsort(raw, kind="stable")
        raw, target = np.asarray(raw, float)[order], np.asarray(target, float)[order]
        # Ties are one point, so equal raw scores get equal shares.
        points, first = np.unique(raw, return_index=True)
        sums = np.add.reduceat(target, first) if len(first) else target
        sizes = np.diff(np.append(first, len(raw)))
        blocks = []
        for point, total, size in zip(points, sums, sizes):
            blocks.append([point, point, total, size])
            while len(blocks) > 1 and (
                blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]
            ):
                _, high, total, size = blocks.pop()
                blocks[-1][1] = high
                blocks[-1][2] += total
                blocks[-1][3] += size
        self.x = np.array([x for low, high, _, _ in blocks for x in (low, high)])
        self.y = np.repeat([total / size for _, _, total, size in blocks], 2)
        return self

    def share(self, raw):
        if not len(self.x):
            return np.zeros(len(raw))
        return np.interp(raw, self.x, self.y)
