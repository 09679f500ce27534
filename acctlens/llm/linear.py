"""Ridge logistic regression for the small, bounded samples models are fitted on."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Logistic:
    """Standardised inputs, Newton steps; with one class only, a constant."""

    def __init__(self, ridge: float = 1.0, steps: int = 25):
        self.ridge, self.steps = ridge, steps

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        spread = x.std(axis=0) if len(x) else np.ones(x.shape[1])
        self.scale = np.where(spread > 1e-9, spread, 1.0)
        self.w = np.zeros(x.shape[1] + 1)
        if len(y) == 0 or y.min() == y.max():
            self.w[-1] = 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0)
            return self
        a = self._inputs(x)
        penalty = np.full(a.shape[1], self.ridge)
        penalty[-1] = 1e-6
        for _ in range(self.steps):
            p = sigmoid(a @ self.w)
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9),
                                   a.T @ (y - p) - penalty * self.w)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._inputs(x) @ self.w

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))
