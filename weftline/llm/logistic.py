"""Logistic regression on a bounded sample, for the classifiers that are fitted on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


class Sparse:
    """Rows of feature numbers, each with the value 1, and some dense columns."""

    def __init__(self, rows: list[list[int]], n_features: int, dense: np.ndarray):
        sizes = np.array([len(r) for r in rows], np.int64)
        self.feature = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.n_rows, self.n_features, self.dense = len(rows), n_features, dense

    def take(self, keep: np.ndarray) -> Sparse:
        out = object.__new__(Sparse)
        place = np.cumsum(keep) - 1
        inside = keep[self.row]
        out.feature, out.row = self.feature[inside], place[self.row[inside]]
        out.n_rows, out.n_features, out.dense = int(keep.sum()), self.n_features, self.dense[keep]
        return out

    def times(self, weights: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, weights[self.feature], self.n_rows) if len(self.row) else 0.0
        return sparse + self.dense @ weights[self.n_features :]

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.feature, values[self.row], self.n_features)
        return np.concatenate([sparse, values @ self.dense])


def fit_logistic(x: Sparse, y: np.ndarray, decay: float = 1e-6, rounds: int = 120, rate: float = 1.0) -> np.ndarray:
    """Weights and, last, the bias, by AdaGrad on all rows with a little weight decay."""
    weights = np.zeros(x.n_features + x.dense.shape[1] + 1)
    steps = np.full(len(weights), 1e-6)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
    weights[-1] = np.log(share / (1 - share))
    for _ in range(rounds if len(y) else 0):
        gap = sigmoid(x.times(weights[:-1]) + weights[-1]) - y
        slope = np.append(x.transposed_times(gap) / len(y) + decay * weights[:-1], gap.mean())
        steps += slope**2
        weights -= rate * slope / np.sqrt(steps)
    return weights
