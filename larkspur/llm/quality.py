"""Quality classifier: a sparse ensemble of rules.

Statistics of whole texts are cut by boosted shallow trees; every path of a
tree is a rule, a conjunction of conditions; lasso logistic regression keeps a
few rules; the kept rules are compiled into one Spark column expression.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import learn, statistics
from .common import drop
from .text import slices

Condition = tuple[int, bool, float]  # statistic, whether it is greater, threshold
BINS = 24


def _grow(binned, cuts, grad, hess, rows, depth, path, out):
    """Split ``rows`` where it pays most; collect each path, return leaf moves."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, -1, 0)
    if depth and len(rows) >= 20:
        for f in range(binned.shape[1]):
            b = binned[rows, f]
            left_g = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1]
            left_h = np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g * g / (h + 1)
            k = int(np.argmax(gain))
            if gain[k] > best[0] and k < len(cuts[f]):
                best = (float(gain[k]), f, k)
    _, f, k = best
    if f < 0:
        return [(rows, -g / (h + 1))]
    moves = []
    for greater in (False, True):
        some = rows[(binned[rows, f] > k) == greater]
        if len(some):
            longer = (*path, (f, greater, float(cuts[f][k])))
            out.append(longer)
            moves += _grow(binned, cuts, grad, hess, some, depth - 1, longer, out)
    return moves


def _simplified(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The tightest condition of each statistic and side."""
    kept: dict[tuple[int, bool], float] = {}
    for f, greater, t in path:
        old = kept.get((f, greater))
        kept[f, greater] = t if old is None else max(old, t) if greater else min(old, t)
    return tuple(sorted((f, greater, t) for (f, greater), t in kept.items()))


def paths(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, seed: int = 3) -> list[tuple[Condition, ...]]:
    """The rules of boosted trees over bootstrap halves of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score, found = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        rows = rng.permutation(len(y))[: max(len(y) // 2, 1)]
        for some, move in _grow(binned, cuts, p - y, p * (1 - p), rows, depth, (), found):
            pass
        # the whole sample follows the last tree's leaves
        score += 0.3 * _leaf_moves(binned, cuts, p - y, p * (1 - p), found, depth)
    return sorted({_simplified(r) for r in found})


def _leaf_moves(binned, cuts, grad, hess, found, depth):
    """Newton steps of the deepest paths of the tree grown last."""
    out = np.zeros(len(grad))
    last = []
    for rule in reversed(found):
        last.append(rule)
        if len(rule) == 1 and rule[0][1] is False:
            break
    longer = {r[:-1] for r in last}
    for rule in (r for r in last if r not in longer):
        held = np.ones(len(grad), bool)
        for f, greater, t in rule:
            held &= (binned[:, f] > np.searchsorted(cuts[f], t, side="left")) == greater
        if held.any():
            out[held] = -grad[held].sum() / (hess[held].sum() + 1)
    return out


class RuleModel:
    """Rules with weights."""

    def __init__(self, rules: list[tuple[Condition, ...]], weights: list[float], bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as one expression over the statistics' columns."""
        total = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights):
            held = None
            for f, greater, t in rule:
                c = stats[statistics.NAMES[f]]
                one = c > t if greater else c <= t
                held = one if held is None else held & one
            total = total + F.when(held, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def described(self) -> list[str]:
        shown = lambda r: " and ".join(f"{statistics.NAMES[f]} {'>' if g else '<='} {t:.4g}" for f, g, t in r)
        return [f"{w:+.3f} if {shown(r)}" for r, w in zip(self.rules, self.weights)]


def matched(x: np.ndarray, rules) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, greater, t in rule:
            out[:, k] *= (x[:, f] > t) if greater else (x[:, f] <= t)
    return out


def fit(x: np.ndarray, y: np.ndarray, lasso: float = 0.001) -> RuleModel:
    if not len(y) or y.min() == y.max():
        return RuleModel([], [], learn.logistic(x, y)[1])
    rules = paths(x, y)
    held = matched(x, rules)
    share = held.mean(axis=0)
    keep = np.flatnonzero((share > 0.002) & (share < 0.998))
    rules, held = [rules[k] for k in keep], held[:, keep]
    weights, bias = learn.logistic(held, y.astype(float), lasso=lasso)
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return RuleModel([rules[k] for k in kept], weights[kept].tolist(), bias)


def _stat_batches(extra: str):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                stats = statistics.of_texts(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column(extra), *[pa.array(stats[:, i]) for i in range(stats.shape[1])]], [extra, *statistics.NAMES])

    return run


def with_statistics(df: DataFrame, extra: str) -> DataFrame:
    kind = dict(df.dtypes)[extra]
    return df.select(extra, "text").mapInArrow(_stat_batches(extra), f"{extra} {kind}, " + ", ".join(f"{n} double" for n in statistics.NAMES))


def learned(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", max_rows: int = learn.MAX_ROWS) -> RuleModel:
    """A model of ``target`` (0 or 1), from at most ``max_rows`` labelled rows
    outside fold 0; only their statistics come to the driver.  Without labels
    of both classes the score is one constant."""
    sample = learn.labelled_sample(docs, labels, target, id_col, text_col, label_id_col, max_rows)
    table = with_statistics(sample, "y").toArrow().to_pandas().sort_values(["y", *statistics.NAMES])
    drop(sample)
    return fit(table[list(statistics.NAMES)].to_numpy(), table["y"].to_numpy())


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``; null and empty texts have zero
    statistics and a score like others; repeated rows and null ids stay.  Only
    the text is looked at."""
    stats = with_statistics(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id")
    return stats.select(F.col("id").alias(id_col), model.column({n: F.col(n) for n in statistics.NAMES}).alias("score"))
