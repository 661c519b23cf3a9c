"""Bounded samples of labelled rows, for operators that learn."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.llm.common import quoted

SAMPLE_ROWS = 20_000


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(quoted(id_col).cast("string").cast("binary")) % folds


def held_out(id_col: str, folds: int, fold_out: int) -> Column:
    return F.coalesce(fold(id_col, folds) == fold_out, F.lit(False))


def training_labels(labels: DataFrame, id_col: str, label: str, folds: int, fold_out: int,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, y) of at most ``rows`` labelled ids outside the held-out fold: those
    with the smallest hashes.  Null ids and labels are left out; of an id with
    several labels the largest counts."""
    known = labels.where(quoted(id_col).isNotNull() & quoted(label).isNotNull())
    known = known.where(fold(id_col, folds) != fold_out)
    known = known.groupBy(quoted(id_col).alias("id")).agg(F.max(quoted(label)).cast("int").alias("y"))
    return known.orderBy(F.xxhash64("id"), "id").limit(rows)


def fit_logistic(x: np.ndarray, y: np.ndarray, l1: float = 0.0, l2: float = 1e-6, rounds: int = 800,
                 offset: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with a lasso penalty, by
    accelerated proximal gradient steps, added to a fixed ``offset`` if there is one.
    One class alone gives an intercept."""
    n, k = x.shape
    fixed = np.zeros(n) if offset is None else offset
    share = (y.sum() + 0.5) / (n + 1)
    w, b = np.zeros(k), float(np.log(share / (1 - share))) if offset is None else 0.0
    if not n or not k or y.min() == y.max():
        return w, b
    both = np.hstack([x, np.ones((n, 1))])
    rate = 4 * n / max(np.linalg.norm(both, 2) ** 2, 1e-12)
    at = now = np.append(w, b)
    momentum = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(both @ at + fixed, -35, 35)))
        gradient = both.T @ (p - y) / n + l2 * at
        after = at - rate * gradient
        after[:-1] = np.sign(after[:-1]) * np.maximum(np.abs(after[:-1]) - rate * l1, 0)
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        at = after + (momentum - 1) / faster * (after - now)
        settled = np.abs(after - now).max() < 1e-7
        now, momentum = after, faster
        if settled:
            break
    return now[:-1], float(now[-1])
