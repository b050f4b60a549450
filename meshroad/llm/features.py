"""Hashed n-gram features and logistic regression, in NumPy, for the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshroad.llm.common import BROADCAST_ROWS

MULTIPLIER = np.uint32(2654435761)


def ngram_counts(raw: bytes, bits: int, orders: tuple[int, ...]) -> np.ndarray:
    """Counts of the byte n-grams of the given orders in 2^bits hash buckets, over the whole text."""
    out = np.zeros(1 << bits, dtype=np.int64)
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    rolled, last = np.zeros(len(data), dtype=np.uint32), 0
    for n in sorted(orders):
        while last < n:  # the n-gram that starts at each byte
            if len(data) <= last:
                return out
            rolled = rolled[:len(data) - last] * np.uint32(257) + data[last:] + np.uint32(1)
            last += 1
        slots = ((rolled + np.uint32(n * 40503)) * MULTIPLIER) >> np.uint32(32 - bits)
        out += np.bincount(slots, minlength=1 << bits)
    return out


def unit(counts: np.ndarray) -> np.ndarray:
    """Damped counts at length one, so that long and short texts compare; all zero for no n-grams."""
    damped = np.sqrt(counts.astype(np.float32))
    size = float(np.sqrt(np.dot(damped, damped)))
    return damped / size if size else damped


def fit_logistic(x: np.ndarray, y: np.ndarray, *, weights: np.ndarray | None = None, l2: float = 1e-4, steps: int = 150,
                 rate: float = 8.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x outputs) and biases of independent logistic regressions; y is 0/1, rows x outputs.

    Nesterov's accelerated gradient over all rows, from zero: the same rows in the same order give the same model.
    """
    n, outputs = x.shape[0], y.shape[1]
    weights = np.ones(n, np.float32) if weights is None else weights.astype(np.float32)
    weights = (weights / weights.sum())[:, None]
    w, b = np.zeros((x.shape[1], outputs), np.float32), np.zeros(outputs, np.float32)
    w_ahead, b_ahead = w.copy(), b.copy()
    for k in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w_ahead + b_ahead, -30, 30)))
        error = (p - y) * weights
        w_new, b_new = w_ahead - rate * (x.T @ error + l2 * w_ahead), b_ahead - rate * error.sum(axis=0)
        push = k / (k + 3.0)
        w_ahead, b_ahead = w_new + push * (w_new - w), b_new + push * (b_new - b)
        w, b = w_new.astype(np.float32), b_new.astype(np.float32)
    return w, b


def bounded_sample(df: DataFrame, group: Column, most: int, id_column: str) -> DataFrame:
    """About `most` rows for each value of `group`, chosen by a hash of the id; at most twice as many in all.

    The groups must be few (labels). The rows are those of lowest hash, so a rerun gives the same ones.
    """
    keyed = df.withColumn("_group", group)
    sizes = keyed.groupBy("_group").count()
    rows = sizes.limit(BROADCAST_ROWS).collect()
    share = F.lit(0.0)
    for r in rows:
        share = F.when(F.col("_group").eqNullSafe(F.lit(r["_group"])), F.lit(min(1.0, most / r["count"]))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(f"`{id_column}`"), F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return keyed.filter(place < share).drop("_group").limit(2 * most * max(1, len(rows)))
