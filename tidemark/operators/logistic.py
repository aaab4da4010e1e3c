"""Ridge logistic regressions fitted together: every penalty and every fold in one pass an iteration (M5).

Newton's method (iteratively reweighted least squares).  A pass over the rows carries the
objective, gradient and Gram matrix of each unfinished fit; fold membership is a mask, so a
cross-validation and the refits on all rows read the table as often as the slowest fit
takes steps.  A step that doesn't lower its objective is halved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.blocks import as_matrix, block_sum, numeric_blocks
from tidemark.functions.ranking import global_cumsum

STEP_TOLERANCE, MAX_PASSES = 1e-9, 200


@dataclass
class RidgeFit:
    """Weights (the intercept first, not penalised) for sum(log loss) + |w|^2 / (2 c), without the rows of ``fold``."""

    c: float
    fold: int | None = None
    weights: np.ndarray | None = None
    passes: int = 0
    finished: bool = False
    objective: float = float("inf")
    trial: np.ndarray | None = None
    step: np.ndarray | None = None


def _loss_sums(blocks: RDD, fits: list[RidgeFit]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Objective, gradient and Gram matrix of each fit at its trial weights, without the penalty."""
    weights = np.column_stack([f.trial for f in fits])
    folds = np.array([-1 if f.fold is None else f.fold for f in fits])
    d = len(weights)

    def run(parts: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((len(fits), 1 + d + d * d))
        for block in parts:
            for lo in range(0, len(block), 4096):
                part = block[lo : lo + 4096]
                y, fold = part[:, 0], part[:, 1]
                x = np.column_stack((np.ones(len(part)), part[:, 2:]))
                z = x @ weights
                p = np.where(z >= 0, 1, np.exp(np.minimum(z, 0))) / (1 + np.exp(-np.abs(z)))
                used = fold[:, None] != folds
                total[:, 0] += ((np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - y[:, None] * z) * used).sum(0)
                total[:, 1 : 1 + d] += ((p - y[:, None]) * used).T @ x
                curve = p * (1 - p) * used
                for s in range(len(fits)):
                    total[s, 1 + d :] += ((x * curve[:, s, None]).T @ x).ravel()
        return total

    return [(float(t[0]), t[1 : 1 + d], t[1 + d :].reshape(d, d)) for t in block_sum(blocks, run)]


def fit_ridge(blocks: RDD, features: int, fits: list[RidgeFit], tolerance: float = STEP_TOLERANCE, max_passes: int = MAX_PASSES) -> list[RidgeFit]:
    """Fit all of ``fits`` on blocks of (label, fold, features...): at most one job a pass.

    A fit is finished when its Newton step is below ``tolerance``, relative to its weights.
    """
    for f in fits:
        f.trial = np.zeros(features + 1)
    penalised = np.r_[0.0, np.ones(features)]
    while todo := [f for f in fits if not f.finished]:
        for f, (loss, gradient, gram) in zip(todo, _loss_sums(blocks, todo)):
            f.passes += 1
            ridge = penalised / f.c
            objective = loss + 0.5 * float(ridge @ f.trial**2)
            if f.weights is not None and not objective <= f.objective + 1e-12 * abs(f.objective):
                f.step = f.step / 2
            else:
                f.weights, f.objective = f.trial, objective
                f.step = np.linalg.lstsq(gram + np.diag(ridge), gradient + ridge * f.weights, rcond=None)[0]
            f.finished = f.passes >= max_passes or bool(np.abs(f.step).max() <= tolerance * (1 + np.abs(f.weights).max()))
            f.trial = f.weights - f.step
    return fits


def cross_validate(train: DataFrame, penalties: Sequence[float], folds: int, features: str = "features") -> tuple[RidgeFit, list[tuple[float, float]]]:
    """The fit on all rows with the penalty of best mean ROC AUC over the folds (a tie: the first), and (c, mean AUC).

    ``train`` has ``label``, ``fold`` and a vector of ``features``; it is read once, into blocks.
    """
    dim = train.select(F.size(vector_to_array(features))).first()
    dim = dim[0] if dim else 0
    values = vector_to_array(features)
    table = train.select(F.col("label").cast("double").alias("label"), F.col("fold").cast("double").alias("fold"), *[values[i].alias(f"x{i}") for i in range(dim)])
    blocks = numeric_blocks(table, table.columns)
    fits = [RidgeFit(c, fold) for c in penalties for fold in [None, *range(folds)]]
    fit_ridge(blocks, dim, fits)
    blocks.unpersist()
    held_out = {(f.c, f.fold): f.weights for f in fits}
    weights = np.array([[held_out[c, fold] for c in penalties] for fold in range(folds)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = as_matrix(batch)
            fold = m[:, 1].astype(np.int64)
            z = np.einsum("nd,ncd->nc", np.column_stack((np.ones(len(m)), m[:, 2:])), weights[fold])
            n, c = z.shape
            cols = [pa.array(np.tile(np.arange(c, dtype=np.int32), n)), pa.array(np.repeat(fold.astype(np.int32), c)), pa.array(z.ravel()), pa.array(np.repeat(m[:, 0], c))]
            yield pa.RecordBatch.from_arrays(cols, names=["c", "fold", "score", "label"])

    auc = grouped_auc(table.mapInArrow(score, "c int, fold int, score double, label double"), ["c", "fold"])
    # bounded: a row for each penalty; a fold of one class has no AUC and doesn't count
    mean = {r.c: r.auc for r in auc.groupBy("c").agg(F.avg("roc_auc").alias("auc")).collect()}
    table_of = [(c, float("nan") if mean.get(i) is None else float(mean[i])) for i, c in enumerate(penalties)]
    best = max(range(len(penalties)), key=lambda i: (-1.0 if np.isnan(table_of[i][1]) else table_of[i][1], -i))
    return next(f for f in fits if f.c == penalties[best] and f.fold is None), table_of


def grouped_auc(scored: DataFrame, keys: list[str]) -> DataFrame:
    """ROC AUC (rank statistic, ties at their mean rank) of each group of (label, score), by one distributed prefix sum."""
    y = F.col("label").cast("int")
    g = scored.groupBy(*keys, "score").agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).withColumn("_k", F.col("pos") + F.col("neg"))
    g = global_cumsum(g, [*keys, "score"], ["_k"])
    below = F.col("_k_cum") - F.col("_k")
    # sums of ranks over the whole table; a group's first rank is taken off at the end
    rank = below + (F.col("_k") + 1) / 2.0
    t = g.groupBy(*keys).agg(F.sum(F.col("pos") * rank).alias("_r"), F.min(below).alias("_start"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    return t.select(*keys, F.try_divide(F.col("_r") - p * F.col("_start") - p * (p + 1) / 2.0, p * n).alias("roc_auc"))
