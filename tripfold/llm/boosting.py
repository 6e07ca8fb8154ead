"""Gradient-boosted trees over a small dense matrix, and isotonic calibration."""

import numpy as np

DEPTH = 3
ROUNDS = 80
RATE = 0.2
BINS = 32
PENALTY = 1.0  # on the squares of leaf values
LEAST_WEIGHT = 4.0  # of the rows in a leaf


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class Trees:
    """Complete trees of one depth; a node that no split improves sends every row left."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        share = float(np.average(labels, weights=weights))
        self.base = float(np.log(share / (1 - share)))
        inner, leaves = 2**DEPTH - 1, 2**DEPTH
        self.features = np.zeros((ROUNDS, inner), dtype=np.int32)
        self.limits = np.full((ROUNDS, inner), np.inf)
        self.leaves = np.zeros((ROUNDS, leaves))
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1])) for column in rows.T]
        binned = np.array(
            [np.searchsorted(e, column) for e, column in zip(edges, rows.T, strict=True)]
        )
        margin = np.full(len(rows), self.base)
        for k in range(ROUNDS):
            chance = _sigmoid(margin)
            gradient = weights * (labels - chance)
            curvature = weights * chance * (1 - chance)
            node = np.zeros(len(rows), dtype=np.int64)
            for level in range(DEPTH):
                first = 2**level - 1
                for own in range(first, 2 * first + 1):
                    inside = np.flatnonzero(node == own)
                    split = self._split(binned, edges, gradient, curvature, weights, inside)
                    if split:
                        self.features[k, own], self.limits[k, own] = split
                go_right = rows[np.arange(len(rows)), self.features[k, node]] > self.limits[k, node]
                node = 2 * node + 1 + go_right
            leaf = node - inner
            pull = np.bincount(leaf, gradient, leaves)
            stiff = np.bincount(leaf, curvature, leaves)
            self.leaves[k] = RATE * pull / (stiff + PENALTY)
            margin += self.leaves[k, leaf]

    @staticmethod
    def _split(binned, edges, gradient, curvature, weights, inside):
        best, found = 1e-6, None
        if not len(inside):
            return None
        g, h, w = gradient[inside], curvature[inside], weights[inside]
        whole = g.sum() ** 2 / (h.sum() + PENALTY)
        for feature, cuts in enumerate(edges):
            if not len(cuts):
                continue
            bins, size = binned[feature, inside], len(cuts) + 1
            left_g = np.cumsum(np.bincount(bins, g, size))[:-1]
            left_h = np.cumsum(np.bincount(bins, h, size))[:-1]
            left_w = np.cumsum(np.bincount(bins, w, size))[:-1]
            gain = left_g**2 / (left_h + PENALTY)
            gain += (g.sum() - left_g) ** 2 / (h.sum() - left_h + PENALTY) - whole
            gain[(left_w < LEAST_WEIGHT) | (w.sum() - left_w < LEAST_WEIGHT)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = gain[at], (feature, cuts[at])
        return found

    def margins(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, features[node]] > limits[node])
            margin += leaves[node - len(features)]
        return margin


class Isotonic:
    """The non-decreasing step function nearest to the labels, joined by straight lines."""

    def __init__(self, margins: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        at, place = np.unique(margins, return_inverse=True)
        pools: list[list[float]] = []  # weight, weighted label, least and greatest margin
        for margin, weight, total in zip(
            at.tolist(),
            np.bincount(place, weights).tolist(),
            np.bincount(place, weights * labels).tolist(),
            strict=True,
        ):
            pools.append([weight, total, margin, margin])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                weight, total, _, greatest = pools.pop()
                pools[-1][0] += weight
                pools[-1][1] += total
                pools[-1][3] = greatest
        self.at = np.array([edge for pool in pools for edge in pool[2:]])
        self.value = np.repeat([total / weight for weight, total, _, _ in pools], 2)

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(margins, self.at, self.value), 0, 1)


class Calibrated:
    """Trees over all rows, calibrated by the margins that trees of the other folds give."""

    def __init__(
        self, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, folds: np.ndarray
    ):
        self.trees = self.calibration = None
        if len(set(labels.tolist())) < 2:
            return
        self.trees = Trees(rows, labels, weights)
        margins = self.trees.margins(rows)
        for fold in np.unique(folds):
            rest = folds != fold
            if len(set(labels[rest].tolist())) == 2:
                fitted = Trees(rows[rest], labels[rest], weights[rest])
                margins[~rest] = fitted.margins(rows[~rest])
        self.calibration = Isotonic(margins, labels, weights)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(rows):
            return np.full(len(rows), 0.5)
        return self.calibration(self.trees.margins(rows))
