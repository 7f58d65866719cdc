"""Small learners for bounded samples: FTRL, temperatures, sampling by hash."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.shared import unit


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return scores / scores.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader with elastic net, per coordinate and class."""

    def __init__(
        self, size: int, classes: int, alpha: float, l1: float, l2: float, beta=1.0
    ):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        pull = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -pull / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def step(self, at: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        """One update of the coordinates ``at`` (each once)."""
        n = self.n[at]
        after = n + gradient**2
        sigma = (np.sqrt(after) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - sigma * weights
        self.n[at] = after


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes softmax(scores / t) fit the labels best, between
    1/20 and 20; 1 if there is nothing to fit."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        chance = softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(chance[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high = -np.log(20.0), np.log(20.0)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def sampled(rows: DataFrame, by: str, most: int) -> tuple[DataFrame, dict]:
    """Rows drawn by a hash of the id, each value of ``by`` at a rate that leaves
    about its part of ``most`` rows; never more than ``most`` in all. Also the rates.
    """
    counts = dict(rows.groupBy(by).count().collect())
    rates = {k: min(1.0, most / len(counts) / n) for k, n in counts.items()}
    rate: Column = F.lit(0.0)
    for value, share in rates.items():
        rate = F.when(F.col(by) == value, share).otherwise(rate)
    draw = unit(F.lit("sample"), "doc_id")
    return rows.filter(draw < rate).orderBy(draw, "doc_id").limit(most), rates


def one_row_each(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with the columns of ``ids``, one row for each id: of
    texts that share an id the one with the smallest hash. ``ids`` comes from
    ``sampled``, so it has a bounded number of rows and may be broadcast, and so has
    the result, however often an id is repeated."""
    found = rows.join(F.broadcast(ids), "doc_id").withColumn("_hash", F.xxhash64("text"))
    least = found.groupBy("doc_id").agg(F.min("_hash").alias("_hash"))
    chosen = found.join(F.broadcast(least), ["doc_id", "_hash"])
    return chosen.dropDuplicates(["doc_id"]).drop("_hash")
