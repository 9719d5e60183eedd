"""Logistic models over sparse rows, fitted on a bounded sample in the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Sparse:
    """Rows of (column, value), flat."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n_rows: int):
        self.rows, self.columns, self.values, self.n_rows = rows, columns, values, n_rows

    @classmethod
    def of(cls, columns: list, values: list | None = None) -> Sparse:
        lengths = np.array([len(c) for c in columns], dtype=np.int64)
        flat = np.concatenate([np.asarray(c, dtype=np.int64) for c in columns]) if len(columns) else np.empty(0, np.int64)
        vals = np.ones(len(flat)) if values is None else np.concatenate([np.asarray(v, dtype=float) for v in values]) if len(values) else np.empty(0)
        return cls(np.repeat(np.arange(len(columns)), lengths), flat, vals, len(columns))

    def only(self, rows: np.ndarray) -> Sparse:
        """The rows where the mask holds, numbered anew."""
        number, keep = np.cumsum(rows) - 1, rows[self.rows]
        return Sparse(number[self.rows[keep]], self.columns[keep], self.values[keep], int(rows.sum()))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.columns], self.n_rows)

    def back(self, rows: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, self.values * rows[self.rows], width)


def fit_logistic(x: Sparse, dense: np.ndarray, target: np.ndarray, width: int, l2: float = 1e-4, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the sparse and the dense columns and the intercept, for targets between 0 and 1 (full-batch Adam)."""
    n, k = max(1, x.n_rows), dense.shape[1]
    theta, m, v = np.zeros(width + k + 1), np.zeros(width + k + 1), np.zeros(width + k + 1)
    base = float(np.clip(target.mean() if len(target) else 0.5, 1e-4, 1 - 1e-4))
    theta[-1] = np.log(base / (1 - base))
    for t in range(1, steps + 1):
        z = x.times(theta[:width]) + dense @ theta[width:-1] + theta[-1]
        off = (sigmoid(z) - target) / n
        gradient = np.concatenate([x.back(off, width), dense.T @ off, [off.sum()]])
        gradient[:-1] += l2 * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient * gradient
        theta -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return theta[:width], theta[width:-1], float(theta[-1])
