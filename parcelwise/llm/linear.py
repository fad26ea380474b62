"""Logistic regression by Newton steps on a bounded matrix of features, for the classifiers of this subpackage."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.mean)
        return np.clip(((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0], -30, 30)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.asarray(x, np.float64)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.3) -> Logistic:
    """Weights for standardised features. With one class, or no row, the logit is a constant: that of the share of
    ones after half a row of each class has been added."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Logistic(np.log(share / (1 - share)), np.ones(0), np.zeros(0))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-6, *[penalty] * x.shape[1]])
    for _ in range(50):
        p = sigmoid(np.clip(a @ w, -30, 30))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w)
