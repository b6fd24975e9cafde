"""Logistic regression on soft labels, for bounded samples on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, steps: int = 80, memory: int = 10) -> np.ndarray:
    """Weights, the last of which is the intercept (not penalised), by limited-memory quasi-Newton
    steps. y: labels between 0 and 1. Without rows all weights are 0."""
    n, d = x.shape
    w = np.zeros(d + 1)
    if not n:
        return w
    weight = np.ones(n) if weight is None else weight
    penalty = np.r_[np.full(d, l2), 1e-6]

    def at(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ w[:-1] + w[-1]
        error = weight * (sigmoid(z) - y)
        loss = float(weight @ (np.logaddexp(0, z) - y * z) + (penalty * w) @ w / 2)
        return loss, np.r_[x.T @ error, error.sum()] + penalty * w

    loss, gradient = at(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(gradient).max() < 1e-6 * n:
            break
        way, parts = -gradient, []
        for s, g, r in reversed(past):
            parts.append(r * (s @ way))
            way = way - parts[-1] * g
        if past:
            s, g, _ = past[-1]
            way = way * (s @ g) / (g @ g)
        else:
            way = way / max(1.0, np.linalg.norm(gradient))
        for (s, g, r), part in zip(past, reversed(parts), strict=True):
            way = way + (part - r * (g @ way)) * s
        size, slope = 1.0, float(gradient @ way)
        while (new := at(w + size * way))[0] > loss + 1e-4 * size * slope and size > 1e-10:
            size /= 2
        step, change = size * way, new[1] - gradient
        if step @ change > 1e-12:
            past = [*past[1 - memory :], (step, change, 1 / (step @ change))]
        w, (loss, gradient) = w + step, new
    return w


def score(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """The values of a column of equally long lists, one after another."""
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(parts) if parts else np.zeros(0)
