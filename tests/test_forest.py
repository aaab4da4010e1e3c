"""Forests read off grown ones: the grid, the cut model, the chosen point."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import churn, forest

GRID = {"depth": [2, 4, None], "leaf": [1, 3], "split": [2, 12], "trees": [3, 6]}


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] * x[:, 1] + 0.6 * rng.normal(size=400) > 0).astype(float)
    rows = [(i, float(a), i % 5, Vectors.dense(v)) for i, (a, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, ["customer_id", "label", "fold", "features"]).repartition(3).cache()


def rows_of(df):
    got = df.orderBy("customer_id").select("label", "fold", vector_to_array("features").alias("x")).collect()
    return np.array([r.x for r in got]), np.array([r.label for r in got]), np.array([r.fold for r in got])


def walk(trees, tree, x, depth, split):
    """One row through one tree."""
    at, level = trees.roots[tree], 0
    while trees.left[at] >= 0 and level < depth and trees.rows[at] >= split:
        at = trees.left[at] if x[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        level += 1
    return trees.share[at]


def test_the_full_grid_has_72_points_in_order():
    points = forest.grid_points(churn.RF_GRID)
    assert len(points) == len(set(points)) == 72
    assert points[0] == forest.Point(5, 1, 2, 100) and points[-1] == forest.Point(None, 4, 10, 200)


def test_points_are_read_off_as_row_by_row(spark, train):
    trees = forest.tree_nodes(spark, forest.grow(train, 6, 1, 42))
    x, _, _ = rows_of(train)
    got = forest.read_off(trees, x[:60], [2, 4, 30], [2, 12], [3, 6])
    for i in range(60):
        for a, depth in enumerate([2, 4, 30]):
            for b, split in enumerate([2, 12]):
                for c, size in enumerate([3, 6]):
                    assert got[i, a, b, c] == pytest.approx(np.mean([walk(trees, t, x[i], depth, split) for t in range(size)]), abs=1e-12)
    assert forest.read_off(trees, x[:0], [2], [2], [6]).shape == (0, 1, 1, 1)


@pytest.mark.parametrize("point", [forest.Point(None, 1, 2, 6), forest.Point(4, 1, 12, 6), forest.Point(2, 1, 2, 3), forest.Point(None, 1, 10_000, 3)])
def test_a_cut_model_scores_like_its_point(spark, train, point):
    model = forest.grow(train, 6, point.leaf, 42)
    x, _, _ = rows_of(train)
    want = forest.read_off(forest.tree_nodes(spark, model), x, [point.max_depth], [point.split], [point.trees])[:, 0, 0, 0]
    small = forest.cut(spark, model, point)
    got = [r.p for r in small.transform(train).orderBy("customer_id").select(vector_to_array("probability")[1].alias("p")).collect()]
    assert np.allclose(got, want, atol=1e-12)
    assert len(small.trees) == point.trees and max(t.depth for t in small.trees) <= point.max_depth


def test_the_grid_takes_one_forest_a_fold_and_leaf(spark, train, monkeypatch):
    grown = []
    real = forest.grow
    monkeypatch.setattr(forest, "grow", lambda t, n, leaf, seed: grown.append((n, leaf)) or real(t, n, leaf, seed))
    best, table = forest.cross_validate(train, GRID, 5, 42, parallelism=3)
    assert sorted(grown) == sorted([(6, leaf) for leaf in (1, 3) for _ in range(5)])
    assert [p for p, _ in table] == forest.grid_points(GRID)
    # the same by hand for three points
    x, y, fold = rows_of(train)
    for at in (0, 7, len(table) - 1):
        point, auc = table[at]
        each = []
        for f in range(5):
            trees = forest.tree_nodes(spark, real(train.where(F.col("fold") != f), 6, point.leaf, 42))
            p = forest.read_off(trees, x[fold == f], [point.max_depth], [point.split], [point.trees]).ravel()
            pos, neg = p[y[fold == f] == 1], p[y[fold == f] == 0]
            each.append(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))
        assert auc == pytest.approx(np.mean(each), abs=1e-9)
    assert best == max(table, key=lambda t: round(t[1], 12))[0]


def test_one_class_has_no_auc_and_the_first_point_wins(spark, train):
    best, table = forest.cross_validate(train.withColumn("label", F.lit(0.0)), {**GRID, "leaf": [1]}, 5, 42)
    assert best == forest.grid_points(GRID)[0] and all(np.isnan(a) for _, a in table)
