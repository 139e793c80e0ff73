"""Gradient-boosted trees for two classes, on arrays: a small learner for bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Trees of a fixed depth on binned features, fitted to the logistic loss by Newton steps."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    ridge: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base, self.nodes = float(np.log(share / (1 - share))), []
        binned, score = self._binned(x), np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            feature, cut, leaf = self._tree(binned, p - y, p * (1 - p))
            self.nodes.append((feature, cut, leaf))
            score += self._walk(binned, feature, cut, leaf)
        return self

    def _tree(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = (1 << self.depth) - 1
        feature, cut, leaf = np.zeros(inner, int), np.full(inner, self.bins), np.zeros(inner + 1)
        at = np.zeros(len(grad), int)
        for node in range(inner):
            own = np.flatnonzero(at == node)
            best = 1e-6
            g, h = grad[own], hess[own]
            whole = g.sum() ** 2 / (h.sum() + self.ridge)
            for j in range(binned.shape[1]):
                left_g = np.cumsum(np.bincount(binned[own, j], g, self.bins))[:-1]
                left_h = np.cumsum(np.bincount(binned[own, j], h, self.bins))[:-1]
                gain = left_g**2 / (left_h + self.ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + self.ridge) - whole
                if len(gain) and gain.max() > best:
                    best, feature[node], cut[node] = gain.max(), j, int(gain.argmax())
            at[own] = 2 * node + 1 + (binned[own, feature[node]] > cut[node])
        for k in range(inner + 1):
            own = at == inner + k
            leaf[k] = -self.rate * grad[own].sum() / (hess[own].sum() + self.ridge)
        return feature, cut, leaf

    def _walk(self, binned: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        at, every = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[every, feature[at]] > cut[at])
        return leaf[at - len(feature)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        if not len(x):
            return np.empty(0)
        binned = self._binned(x)
        return 1 / (1 + np.exp(-self.base - sum(self._walk(binned, *tree) for tree in self.nodes)))


def threshold_for(scores: np.ndarray, truth: np.ndarray, precision: float) -> float:
    """The lowest score from which on the wanted share of cases is true; above 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    last_of_ties = np.append(scores[order][1:] != scores[order][:-1], True) if len(order) else np.empty(0, bool)
    good = np.flatnonzero((right >= precision) & last_of_ties)
    return float(scores[order][good[-1]]) if len(good) else 1.1
