"""A small random forest on numeric features: bootstrap rows, random features per split, Gini."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray   # -1 in leaves
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray     # positives among the rows that reached the node

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return self.share[node]
            at = node[inner]
            node[inner] = np.where(x[inner, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray, least: int):
    """Best (gain, feature, cut) among some features, over all cuts between distinct values."""
    best = (1e-9, -1, 0.0)
    n, total = len(y), y.sum()
    parent = total * (n - total) / n
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, c = x[order, f], np.cumsum(y[order])[:-1]
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
        if not ok.any():
            continue
        impurity = c * (k - c) / k + (total - c) * (n - k - total + c) / (n - k)
        gain = np.where(ok, parent - impurity, -1)
        i = int(np.argmax(gain))
        if gain[i] > best[0]:
            best = (float(gain[i]), int(f), float((v[i] + v[i + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, chance: np.random.Generator, depth: int, tries: int, least: int) -> Tree:
    feature, cut, left, right, share = [], [], [], [], []
    waiting = [(np.arange(len(y)), 0, -1, False)]
    while waiting:
        rows, level, parent, is_right = waiting.pop()
        me = len(feature)
        if parent >= 0:
            (right if is_right else left)[parent] = me
        feature.append(-1)
        cut.append(0.0)
        left.append(0)
        right.append(0)
        share.append(float(y[rows].mean()) if len(rows) else 0.0)
        if level < depth and 0 < share[me] < 1:
            _, f, c = _split(x[rows], y[rows], chance.choice(x.shape[1], tries, replace=False), least)
            if f >= 0:
                feature[me], cut[me] = f, c
                low = x[rows, f] <= c
                waiting += [(rows[low], level + 1, me, False), (rows[~low], level + 1, me, True)]
    return Tree(*(np.array(a) for a in (feature, cut, left, right, share)))


@dataclass
class Forest:
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if self.trees else np.zeros(len(x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 31, depth: int = 8, least: int = 2, seed: int = 5) -> Forest:
    """A forest for labels 0 and 1; without rows it predicts 0."""
    if not len(y):
        return Forest([])
    chance = np.random.default_rng(seed)
    tries = max(1, int(np.ceil(np.sqrt(x.shape[1]))))
    out = []
    for _ in range(trees):
        rows = chance.integers(0, len(y), len(y))
        out.append(grow(x[rows], y[rows].astype(float), chance, depth, tries, least))
    return Forest(out)
