"""Logistic regression by Newton's method for small, bounded samples."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights of the columns of ``x`` and, last, the intercept.  ``y`` may be a
    probability.  Without rows, or with one class only, the intercept alone moves."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = predict_raw(x, w)
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-9:
            break
    return w


def predict_raw(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return predict_raw(np.column_stack([x, np.ones(len(x))]), w)
