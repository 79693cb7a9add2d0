"""Bounded, balanced samples of labelled rows, and the logistic regression that is fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_labels(labels: DataFrame, key: str, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` rows (key, label) of each of the labels 0 and 1, chosen by hash, and how many there are of each.

    Rows with a null key or another label are left out; a key with both labels counts as 1, repeated rows as one.
    """
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("key"), "key").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1]), {k: counts.get(k, 0) for k in (0, 1)}


class Rows:
    """Sparse rows: the features of row i are cells[at[i]:at[i + 1]], with their values."""

    def __init__(self, cells: list[np.ndarray], values: list[np.ndarray]):
        sizes = np.array([len(c) for c in cells])
        self.n = len(cells)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.cells = np.concatenate(cells) if cells else np.empty(0, np.int64)
        self.values = np.concatenate(values) if values else np.empty(0)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * weights[self.cells], minlength=self.n)

    def back(self, x: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.cells, self.values * x[self.row], minlength=width)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(rows: Rows, y: np.ndarray, width: int, penalty: float, steps: int = 150, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and offset of least penalised log loss, by Adam over all rows."""
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, steps + 1):
        r = (sigmoid(rows.dot(w) + b) - y) / max(rows.n, 1)
        g = np.append(rows.back(r, width) + penalty * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def calibrate(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities: Platt scaling by Newton steps, with smoothed targets."""
    positives, negatives = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * z + b)
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(a), float(b)
