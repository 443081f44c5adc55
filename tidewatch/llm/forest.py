"""A random forest for small labelled tables, trained on the driver and applied
to feature matrices in tasks.  Bootstrap samples, a random subset of features at
every split, Gini impurity over quantile bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Trees as flat arrays: child numbers, feature, threshold, and the share of
    positives at each node."""

    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    child: list[np.ndarray]         # left child; the right one follows it; -1 at a leaf
    share: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of positives over the trees, per row."""
        total = np.zeros(len(x))
        for feature, threshold, child, share in zip(self.feature, self.threshold, self.child, self.share):
            at = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(child[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = child[node] + (x[inner, feature[node]] > threshold[node])
            total += share[at]
        return total / max(1, len(self.feature))


def _best_split(binned: np.ndarray, y: np.ndarray, features: np.ndarray, bins: int, least: int):
    best = (0.0, -1, -1)
    n, ones = len(y), y.sum()
    whole = ones * (n - ones) / n
    for f in features:
        n_left = np.cumsum(np.bincount(binned[:, f], minlength=bins))[:-1]
        ones_left = np.cumsum(np.bincount(binned[:, f], weights=y, minlength=bins))[:-1]
        n_right, ones_right = n - n_left, ones - ones_left
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = ones_left * (n_left - ones_left) / n_left + ones_right * (n_right - ones_right) / n_right
        impurity[(n_left < least) | (n_right < least)] = np.inf
        cut = int(np.argmin(impurity))
        if whole - impurity[cut] > best[0] + 1e-12:
            best = (whole - impurity[cut], int(f), cut)
    return best


def train_forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 10, least: int = 2, bins: int = 32,
                 seed: int = 1) -> Forest:
    """``y`` holds 0 or 1.  The same arguments give the same forest."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    tried = max(1, int(np.sqrt(x.shape[1])) + 1)
    forest = Forest([], [], [], [])
    for _ in range(trees):
        feature, threshold, child, share = [0], [0.0], [-1], [0.0]
        stack = [(0, rng.integers(0, len(y), len(y)), 0)]
        while stack:
            node, rows, level = stack.pop()
            labels = y[rows]
            share[node] = float(labels.mean())
            if level == depth or len(rows) < 2 * least or labels.min() == labels.max():
                continue
            gain, f, cut = _best_split(binned[rows], labels, rng.permutation(x.shape[1])[:tried], bins, least)
            if f < 0 or cut >= len(edges[f]):
                continue
            feature[node], threshold[node], child[node] = f, float(edges[f][cut]), len(feature)
            right = binned[rows, f] > cut
            for part in (rows[~right], rows[right]):
                stack.append((len(feature), part, level + 1))
                feature.append(0)
                threshold.append(0.0)
                child.append(-1)
                share.append(0.0)
        forest.feature.append(np.array(feature))
        forest.threshold.append(np.array(threshold))
        forest.child.append(np.array(child))
        forest.share.append(np.array(share))
    return forest
