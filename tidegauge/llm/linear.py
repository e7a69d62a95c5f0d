"""Logistic regression on a bounded sample, by Newton's method."""

from __future__ import annotations

import numpy as np

STEPS = 25
PENALTY = 1.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights and, last, the intercept. The penalty spares the intercept.

    With labels of one kind only, or none, the weights are 0 and the intercept is the
    log odds of the labels with one row of each kind added.
    """
    n, k = x.shape
    weights = np.zeros(k + 1)
    good = float(y.sum())
    weights[-1] = np.log((good + 1) / (n - good + 1))
    if good in (0.0, float(n)):
        return weights
    ones = np.column_stack([x, np.ones(n)])
    ridge = np.append(np.full(k, penalty), 1e-9)
    for _ in range(STEPS):
        p = sigmoid(ones @ weights)
        gradient = ones.T @ (p - y) + ridge * weights
        curve = (ones * (p * (1 - p))[:, None]).T @ ones + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        weights -= step * min(1.0, 8 / max(size, 1e-12))
        if size < 1e-6:
            break
    return weights


def predict(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return sigmoid(x @ weights[:-1] + weights[-1])


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of highest F1, in the middle of the widest such gap; 0.5 without positives."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    p = np.append(p[order], 0.0)
    real = p[:-1] > p[1:]  # a cut between equal values is none
    f1 = np.where(real, f1, -1.0)
    ends = np.flatnonzero(f1 == f1.max())
    at = ends[np.argmax(p[ends] - p[ends + 1])]
    return float((p[at] + p[at + 1]) / 2)
