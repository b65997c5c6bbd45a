"""Sparse multinomial logistic regression by follow-the-regularised-leader, with a calibrated temperature."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

Features = tuple[np.ndarray, np.ndarray]  # positions and weights


@dataclass
class Settings:
    """Step size, its smoothing, the two penalties of the elastic net, and passes over the sample."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 5
    seed: int = 42


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray  # one row per position, then the intercept
    idf: np.ndarray
    temperature: float = 1.0
    notes: dict = field(default_factory=dict)

    def weigh(self, positions: np.ndarray, counts: np.ndarray) -> Features:
        """TF-IDF with dampened counts, of unit length."""
        values = (1.0 + np.log(counts)) * self.idf[positions]
        return positions, values / max(np.sqrt(values @ values), 1e-12)

    def probabilities(self, features: Features) -> np.ndarray:
        return softmax(self.logits(features) / self.temperature)

    def logits(self, features: Features) -> np.ndarray:
        positions, values = features
        return values @ self.weights[positions] + self.weights[-1]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def inverse_frequencies(documents: int, containing: np.ndarray) -> np.ndarray:
    return np.log((1.0 + documents) / (1.0 + containing)) + 1.0


def fit(rows: Sequence[Features], labels: Sequence[int], classes: list[str], idf: np.ndarray, settings: Settings | None = None) -> Model:
    """Per-coordinate FTRL-proximal over ``rows``; a fifth of them are kept back to fit the temperature."""
    s = settings or Settings()
    size = len(idf) + 1
    z, n = np.zeros((size, len(classes))), np.zeros((size, len(classes)))
    order = np.random.default_rng(s.seed).permutation(len(rows))
    back = set(order[: len(rows) // 5].tolist()) if len(rows) >= 10 * len(classes) else set()
    learn = [i for i in order.tolist() if i not in back]
    model = Model(classes, z, idf)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for i in learn:
            positions, values = rows[i]
            at = np.append(positions, size - 1)
            x = np.append(values, 1.0)
            w = weights(z[at], n[at])
            p = softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p[None, :]
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / s.alpha * w
            n[at] = more
    model.weights = weights(z, n)
    held = sorted(back) or list(range(len(rows)))
    if held:
        scores = np.array([model.logits(rows[i]) for i in held])
        truth = np.array([labels[i] for i in held])
        model.temperature = temperature(scores, truth)
        model.notes = {"held": len(held), "accuracy": float((scores.argmax(1) == truth).mean()), "sparsity": float((model.weights == 0).mean())}
    return model


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """What the logits are divided by to minimise the log loss, by golden-section search on a log scale."""

    def loss(t: float) -> float:
        x = logits / np.exp(t)
        x = x - x.max(1, keepdims=True)
        return float((np.log(np.exp(x).sum(1)) - x[np.arange(len(truth)), truth]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5.0) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
