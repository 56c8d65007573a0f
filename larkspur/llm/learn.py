"""Labelled samples and penalised logistic regression for small models."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, written

#: Most labelled rows that a classifier is fitted on.
MAX_ROWS = 12_000


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, id_col: str, text_col: str, label_id_col: str, max_rows: int) -> DataFrame:
    """(text, y) of at most ``max_rows`` labelled rows outside fold 0, taken by
    hash of the id and kept in the shared folder.  Labels that are null or not
    0 or 1 are no labels.  Of documents that repeat an id, the least text
    counts, once."""
    good = F.col(target).isin(0, 1) & (fold_of(F.col(label_id_col)) != 0) & F.col(label_id_col).isNotNull()
    picked = labels.where(good).select(F.col(label_id_col).alias("id"), F.col(target).cast("int").alias("y"))
    picked = picked.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = source.join(F.broadcast(picked), "id").groupBy("id").agg(F.min(F.struct("text", "y")).alias("one"))
    return written(one.select("one.text", "one.y"), "sample")


class Sparse:
    """A matrix of few entries, as far as ``logistic`` needs one."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.row, self.column, self.value, self.shape = row, column, value, shape

    @property
    def T(self) -> Sparse:  # noqa: N802
        return Sparse(self.column, self.row, self.value, self.shape[::-1])

    def __matmul__(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * v[self.column], self.shape[0])


def logistic(x: np.ndarray | Sparse, y: np.ndarray, lasso: float = 0.0, ridge: float = 0.0, positive: bool = False, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps.  With one
    class only, no weights and the intercept of its smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = math.log(share / (1 - share))
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max() or not x.shape[1]:
        return w, bias
    v = np.ones(x.shape[1]) / math.sqrt(x.shape[1])
    for _ in range(20):  # the largest eigenvalue, by power iteration
        v = x.T @ (x @ v)
        norm = float(np.linalg.norm(v))
        v = v / max(norm, 1e-12)
    step = 1 / (0.25 * (norm / len(y) * 1.05 + 1) + ridge)
    w_look, b_look, t = w.copy(), bias, 1.0
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(x @ w_look + b_look, -40, 40))) - y
        w_new = w_look - step * (x.T @ miss / len(y) + ridge * w_look)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * lasso, 0)
        w_new = np.maximum(w_new, 0) if positive else w_new
        b_new = b_look - step * miss.mean()
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w_look, b_look = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - bias)
        w, bias, t = w_new, b_new, t_new
    return w, float(bias)
