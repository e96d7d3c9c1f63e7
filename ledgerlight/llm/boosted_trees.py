"""Gradient-boosted trees for a yes or no label: logistic loss, second-order leaf values, splits between bins of equal counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS, DEPTH, TREES, RATE, RIDGE, LEAST_WEIGHT = 32, 4, 80, 0.2, 1.0, 1.0


@dataclass(frozen=True)
class Forest:
    """Complete trees of DEPTH levels: the feature and threshold of each inner node, the value of each leaf, and the start value."""

    start: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def logits(self, matrix: np.ndarray) -> np.ndarray:
        rows = np.arange(len(matrix))
        out = np.full(len(matrix), self.start)
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(matrix), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (matrix[rows, features[at]] > thresholds[at])
            out += leaves[at - len(features)]
        return out


def loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit(matrix: np.ndarray, labels: np.ndarray, trees: int = TREES) -> Forest:
    """Trees over the rows of ``matrix``; the result depends on the rows and their order alone."""
    n, width = matrix.shape
    edges = [np.unique(np.quantile(matrix[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(edge, matrix[:, f], side="left") for f, edge in enumerate(edges)], axis=1)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    logits, inner = np.full(n, start), 2 ** DEPTH - 1
    built = []
    for _ in range(trees):
        likely = 1 / (1 + np.exp(-logits))
        slope, bend = likely - labels, likely * (1 - likely)
        features, thresholds = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, nodes = 2 ** level - 1, 2 ** level
            place = at - first
            best, chosen, cut = np.full(nodes, 1e-6), np.zeros(nodes, np.int64), np.full(nodes, BINS)
            for f in range(width):
                cell = place * BINS + binned[:, f]
                g = np.bincount(cell, slope, nodes * BINS).reshape(nodes, BINS)
                h = np.bincount(cell, bend, nodes * BINS).reshape(nodes, BINS)
                left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g ** 2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g ** 2 / (all_h + RIDGE)
                gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
                gain[:, len(edges[f]):] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(nodes), top]
                better = value > best
                best[better], chosen[better], cut[better] = value[better], f, top[better]
            for node in range(nodes):
                if cut[node] < BINS:
                    features[first + node], thresholds[first + node] = chosen[node], edges[chosen[node]][cut[node]]
            at = 2 * at + 1 + (binned[np.arange(n), chosen[place]] > cut[place])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        leaves = -RATE * g / (h + RIDGE)
        logits += leaves[leaf]
        built.append((features, thresholds, leaves))
    return Forest(start, *(np.stack(part) for part in zip(*built)))
