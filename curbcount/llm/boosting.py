"""Gradient-boosted trees for two classes, over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32
DEPTH = 3


@dataclass
class BoostedTrees:
    """Logistic loss, Newton leaves. A tree is a full binary one: (feature, bin) per inner node, then leaves."""

    trees: int = 60
    rate: float = 0.2
    ridge: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            at, tree = self._grow(binned, y - p, p * (1 - p))
            self.nodes.append(tree)
            score += tree[2][at]
        return self

    def _grow(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray):
        feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, BINS)
        at = np.zeros(len(grad), int)
        for level in range(DEPTH):
            first = 2**level - 1
            for node in range(2**level):
                own = at == node
                if own.sum() > 1:
                    feature[first + node], cut[first + node] = self._split(binned[own], grad[own], hess[own])
            at = 2 * at + (binned[np.arange(len(at)), feature[first + at]] > cut[first + at])
        g, h = (np.bincount(at, v, minlength=2**DEPTH) for v in (grad, hess))
        return at, (feature, cut, self.rate * g / (h + self.ridge))

    def _split(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int]:
        best, where = 1e-9, (0, BINS)
        for j in range(binned.shape[1]):
            g, h = (np.cumsum(np.bincount(binned[:, j], v, minlength=BINS)) for v in (grad, hess))
            gain = g**2 / (h + self.ridge) + (g[-1] - g) ** 2 / (h[-1] - h + self.ridge) - g[-1] ** 2 / (h[-1] + self.ridge)
            k = int(gain[:-1].argmax())
            if gain[k] > best:
                best, where = gain[k], (j, k)
        return where

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        score = np.full(len(x), self.base)
        for feature, cut, leaf in self.nodes:
            at = np.zeros(len(x), int)
            for level in range(DEPTH):
                node = 2**level - 1 + at
                at = 2 * at + (binned[np.arange(len(x)), feature[node]] > cut[node])
            score += leaf[at]
        return 1 / (1 + np.exp(-score))
