"""Batched ridge logistic regressions against single fits, Spark ML and a plain AUC."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from tidemark.functions.blocks import numeric_blocks
from tidemark.operators import churn, logistic


def data(n=900, d=4, seed=1, separable=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    z = x @ rng.normal(size=d) * 2 - 0.5
    y = (z > 0) if separable else rng.random(n) < 1 / (1 + np.exp(-z))
    return x, y.astype(float), rng.integers(0, 5, n)


def frame(spark, x, y, fold):
    rows = [(i, float(a), int(f), Vectors.dense(v)) for i, (v, a, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, ["customer_id", "label", "fold", "features"]).repartition(3)


def single(x, y, c):
    """Newton with a line search, one fit."""
    x = np.column_stack((np.ones(len(x)), x))
    ridge = np.r_[0, np.full(x.shape[1] - 1, 1 / c)]
    value = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * ridge @ w**2
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        while value(w - step) > value(w) + 1e-9:
            step = step / 2
        w = w - step
    return w


@pytest.mark.parametrize("separable", [False, True])
def test_twenty_four_fits_at_once_equal_single_fits(spark, separable):
    x, y, fold = data(separable=separable)
    table = spark.createDataFrame([(float(a), float(f), *map(float, v)) for v, a, f in zip(x, y, fold)], ["label", "fold", "x0", "x1", "x2", "x3"]).repartition(3)
    blocks = numeric_blocks(table, table.columns)
    fits = [logistic.RidgeFit(c, f) for c in churn.LR_C_GRID for f in [None, 0, 1, 2, 3, 4]]
    jobs = []
    was, logistic._loss_sums = logistic._loss_sums, lambda b, f: jobs.append(len(f)) or was(b, f)
    try:
        logistic.fit_ridge(blocks, 4, fits)
    finally:
        logistic._loss_sums = was
    for f in fits:
        use = np.ones(len(y), bool) if f.fold is None else fold != f.fold
        assert np.allclose(f.weights, single(x[use], y[use], f.c), atol=1e-6)
    assert len(jobs) == max(f.passes for f in fits) < 40 and jobs[0] == 24


def test_cross_validation_and_model(spark):
    x, y, fold = data(seed=3)
    train = frame(spark, x, y, fold)
    best, table = logistic.cross_validate(train, churn.LR_C_GRID, 5)
    want = []
    for c in churn.LR_C_GRID:
        aucs = []
        for f in range(5):
            w = single(x[fold != f], y[fold != f], c)
            s, t = x[fold == f] @ w[1:], y[fold == f]
            pos, neg = s[t == 1], s[t == 0]
            aucs.append(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))
        want.append(np.mean(aucs))
    assert [c for c, _ in table] == churn.LR_C_GRID and np.allclose([a for _, a in table], want, atol=1e-9)
    assert best.c == churn.LR_C_GRID[int(np.argmax(want))]
    # Spark's own fit of the same penalty, and the model made from the weights
    n = len(y)
    own = LogisticRegression(regParam=1 / (best.c * n), elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-12).fit(train)
    model = churn._logistic_model(spark, best.weights)
    assert np.allclose(model.coefficients.toArray(), own.coefficients.toArray(), atol=1e-4)
    a = {r.customer_id: r.probability[1] for r in model.transform(train).collect()}
    b = {r.customer_id: r.probability[1] for r in own.transform(train).collect()}
    assert all(abs(a[k] - b[k]) < 1e-4 for k in a)


def test_one_class_and_ties(spark):
    x, y, fold = data(n=60)
    best, table = logistic.cross_validate(frame(spark, x, np.zeros(60), fold), [0.1, 1.0], 5)
    assert best.c == 0.1 and all(np.isnan(a) for _, a in table) and np.isfinite(best.weights).all()
    best, table = logistic.cross_validate(frame(spark, np.zeros((60, 2)), y, fold), [0.1, 1.0], 5)
    assert best.c == 0.1 and table[0][1] == table[1][1] == 0.5
