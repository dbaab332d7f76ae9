"""Logistic regression on a bounded sample: sparse rows, then a calibrated probability."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_sparse(
    rows: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray, size: int,
    steps: int = 120, rate: float = 0.2, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam; entry ``k`` is ``values[k]`` at ``rows[k], slots[k]``.

    Both labels weigh the same, however many rows each has.
    """
    w, b = np.zeros(size + 1), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels != 1).sum()))
    for t in range(1, steps + 1):
        z = np.bincount(rows, values * w[slots], len(labels)) + w[size]
        error = (sigmoid(z) - labels) * share
        g = np.bincount(slots, values * error[rows], size + 1) + decay * w
        g[size] = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    b = float(w[size])
    return w[:size], b


def fit_dense(x: np.ndarray, labels: np.ndarray, decay: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a few columns, the last for the bias, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.eye(len(w)) * decay
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (p - labels) + keep @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w
