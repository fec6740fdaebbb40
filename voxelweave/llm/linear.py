"""A small weighted logistic regression (Newton steps) for bounded training samples."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Fitted on standardised features; targets may be probabilities."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, steps: int = 40):
        weight = np.ones(len(y)) if weight is None else weight
        self.mean, self.sd = np.average(x, axis=0, weights=weight), x.std(axis=0) + 1e-9
        a = self._design(x)
        ridge = np.full(a.shape[1], l2)
        ridge[-1] = 1e-3
        self.w = np.zeros(a.shape[1])
        for _ in range(steps):
            p = self._sigmoid(a @ self.w)
            grad = a.T @ (weight * (p - y)) + ridge * self.w
            step = np.linalg.solve((a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(ridge), grad)
            step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
            self.w -= step
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) / self.sd, -20, 20), np.ones(len(x))]

    @staticmethod
    def _sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self._design(x) @ self.w)


class Constant:
    """Where there is nothing to learn from, or one class only."""

    def __init__(self, p: float):
        self.p = p

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic | Constant:
    if not len(y) or np.ptp(y) < 1e-9:
        return Constant(float(np.mean(y)) if len(y) else 0.5)
    return Logistic(x, y, weight)
