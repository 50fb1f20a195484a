"""Multinomial logistic regression trained by follow-the-regularised-leader.

Runs on a bounded sample of sparse rows on the driver.
"""

from __future__ import annotations

import numpy as np


class Ftrl:
    """FTRL-proximal with elastic net: l1 makes weights exactly zero, l2 shrinks the rest."""

    def __init__(self, n_features: int, n_classes: int, alpha=0.3, beta=1.0, l1=0.5, l2=1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((n_features + 1, n_classes))  # the last row is the bias
        self.n = np.zeros((n_features + 1, n_classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        rows = np.append(index, len(self.z) - 1)
        x = np.append(value, 1.0)
        w = self.weights(rows)
        p = softmax((x @ w)[None])[0]
        p[label] -= 1.0
        g = x[:, None] * p[None]
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, epochs: int = 3, seed: int = 7, **options):
    """Weights (features + bias, classes) after ``epochs`` shuffled passes."""
    model = Ftrl(n_features, n_classes, **options)
    rnd = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rnd.permutation(len(rows)):
            model.learn(*rows[k])
    return model.weights()


def logits_of(weights: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    return value @ weights[index] + weights[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss: ternary search, the loss is convex in 1 / T."""
    if not len(labels):
        return 1.0

    def loss(inverse: float) -> float:
        return -np.log(softmax(logits * inverse)[np.arange(len(labels)), labels] + 1e-300).mean()

    lo, hi = 0.02, 20.0
    for _ in range(60):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return 2 / (lo + hi)
