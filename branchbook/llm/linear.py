"""Follow-the-regularised-leader (proximal) for sparse linear models, and bounded training samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Ftrl:
    """FTRL-proximal: per-coordinate learning rates, L1 and L2 (elastic net); one weight column per class."""

    def __init__(self, dim: int, classes: int = 1, alpha: float = 0.1, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((dim, classes))
        self.n = np.zeros((dim, classes))

    def weights(self, idx: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, idx: np.ndarray, x: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        """One example: distinct coordinates, their values, d loss / d score by class, weights now."""
        g = x[:, None] * gradient[None, :]
        sigma = (np.sqrt(self.n[idx] + g * g) - np.sqrt(self.n[idx])) / self.alpha
        self.z[idx] += g - sigma * w
        self.n[idx] += g * g


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, passes: int, memory: int = 10, least: float = 1e-5) -> np.ndarray:
    """A minimum of ``loss`` (value and gradient) from ``w`` on, by limited-memory quasi-Newton steps with halving.

    At most ``passes`` evaluations; ends where a step gains less than ``least`` of the value.
    """
    value, grad = loss(w)
    passes -= 1
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    while passes > 0 and np.abs(grad).max() > 1e-7:
        way, back = grad.copy(), []
        for s, y in reversed(kept):
            back.append((s @ way) / (s @ y))
            way -= back[-1] * y
        way *= (kept[-1][0] @ kept[-1][1]) / (kept[-1][1] @ kept[-1][1]) if kept else 1.0 / max(1.0, np.linalg.norm(grad))
        for (s, y), a in zip(kept, reversed(back)):
            way += s * (a - (y @ way) / (s @ y))
        slope, size = -(grad @ way), 1.0
        while passes > 0:
            near, passes = w - size * way, passes - 1
            new, new_grad = loss(near)
            if new <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            return w
        s, y, gain = near - w, new_grad - grad, value - new
        if s @ y > 1e-12 * (y @ y):
            kept = [*kept, (s, y)][-memory:]
        w, value, grad = near, new, new_grad
        if gain < least * abs(value):
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id falls outside every remainder."""
    return F.crc32(F.col(doc_id).cast("string")) % of


def class_quotas(counts: dict, limit: int, least: int) -> dict:
    """How many examples to take of each class: its share of ``limit``, or ``least`` (all it has, if fewer)."""
    total = sum(counts.values())
    return {c: min(n, max(least, round(limit * n / total))) for c, n in counts.items()}


def class_sample(known: DataFrame, label: str, counts: dict, quotas: dict) -> DataFrame:
    """(doc_id, label) of the least hashed ids of every class: all below the quota's part of the hash's range.

    ``known`` has distinct rows (doc_id, label), ``counts`` their numbers by class. A class
    above its quota gives about as many rows, up to the spread of the hash; no rows are ranked.
    """
    schema = f"{label} {known.schema[label].dataType.simpleString()}, __below bigint"
    given = known.sparkSession.createDataFrame([(c, 2**62 * q // counts[c]) for c, q in quotas.items()], schema)
    near = known.select("doc_id", label).join(F.broadcast(given), label)
    return near.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) < F.col("__below")).select("doc_id", label)


def log_shift(share: float, sample_share: float) -> float:
    """What a class taken at another rate than its share adds to its score."""
    return float(np.log(share / sample_share))
