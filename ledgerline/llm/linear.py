"""A logistic regression over sparse rows with soft labels, fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: row i has the features ``index[at[i]:at[i + 1]]`` with their values."""

    def __init__(self, at: np.ndarray, index: np.ndarray, value: np.ndarray):
        self.at, self.index, self.value = at, index, value
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(at))

    def __len__(self) -> int:
        return len(self.at) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.index], minlength=len(self))

    def back(self, error: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, self.value * error[self.row], minlength=size)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(rows: Rows, target: np.ndarray, size: int, l2: float, rounds: int = 300, rate: float = 0.3, counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias, by full-batch gradient steps with per-weight step sizes (Adam); row i stands for ``counts[i]`` equal ones."""
    if not len(rows):
        return np.zeros(size), 0.0
    counts = np.ones(len(rows)) if counts is None else counts
    w = np.zeros(size + 1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        error = (sigmoid(rows.dot(w[:-1]) + w[-1]) - target) * counts / counts.sum()
        g = np.append(rows.back(error, size) + l2 * w[:-1], error.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])
