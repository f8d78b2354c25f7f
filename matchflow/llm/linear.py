"""What the linear classifiers share: bounded samples and full-batch gradient descent."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 1 << 30


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key``, and the same ones for the same rows."""
    total = rows.count()
    hashed = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(RANGE))
    return rows.where(hashed < int(min(1.0, 1.1 * most / max(total, 1)) * RANGE)).orderBy(hashed, key).limit(most)


def descend(gradient: Callable[[np.ndarray, float], tuple[np.ndarray, float]], size: int, penalty: float, rounds: int = 400, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam steps on the whole gradient; ``penalty`` pulls the weights to zero."""
    weights, intercept = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for i in range(1, rounds + 1):
        by_weight, by_intercept = gradient(weights, intercept)
        g = np.append(by_weight + penalty * weights, by_intercept)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        step = rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
        weights, intercept = weights - step[:-1], intercept - step[-1]
    return weights, float(intercept)
