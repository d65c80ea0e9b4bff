"""Small gradient-boosted trees for bounded samples; a model is a few arrays that travel with a task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
DEPTH = 3
TREES = 80
RATE = 0.2
LEAST_WEIGHT = 2.0
RIDGE = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: feature and cut per inner node in level order, value per leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _best_cut(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int]:
    """Feature and bin whose cut lowers the logistic loss most; (0, BINS) if none does."""
    best, where = 1e-6, (0, BINS)
    g, h = grad.sum(), hess.sum()
    for f in range(binned.shape[1]):
        left_g = np.cumsum(np.bincount(binned[:, f], grad, BINS))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, f], hess, BINS))[:-1]
        right_g, right_h = g - left_g, h - left_h
        gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g**2 / (h + RIDGE)
        gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, where = gain[k], (f, k)
    return where


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of logistic loss on histograms of each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    inner = (1 << DEPTH) - 1
    features, cuts, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            f, b = _best_cut(binned[at], grad[at], hess[at]) if len(at) else (0, BINS)
            if b < len(edges[f]):
                feature[k], cut[k] = f, edges[f][b]
            node[at] = 2 * k + 1 + (x[at, feature[k]] > cut[k])
        node -= inner
        size = 1 << DEPTH
        leaf = RATE * np.bincount(node, grad, size) / (np.bincount(node, hess, size) + RIDGE)
        margin += leaf[node]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(cuts), np.array(leaves))
