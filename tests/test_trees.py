"""Trees grown in numpy against a plain recursion, and forests against Spark ML's."""

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import churn, forest, trees

SEED, TAKE = 7, 2


def table(n=260, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=(n, 2)), rng.integers(0, 4, n), np.zeros(n)]).astype(float)
    y = (x[:, 0] * x[:, 1] + 0.4 * rng.normal(size=n) > 0).astype(np.uint8)
    splits = [trees.thresholds([trees.summary(v)]) for v in x.T]
    return x, y, splits, np.ascontiguousarray(2 * trees.binned(x, splits) + y[:, None])


def plain(bins, y, weight, key, leaf, depth):
    """A node as (rows, share) or (rows, share, feature, bin, left, right), grown one by one."""
    count = [weight[y == c].sum() for c in (0, 1)]
    n, best = sum(count), None
    node = (n, count[1] / n)
    if depth == forest.UNLIMITED or min(count) == 0:
        return node, count
    own = sum(c * c for c in count) / n
    for f in trees._drawn(key, bins.shape[1], TAKE)[0]:
        for b in range(trees.BINS - 1):
            left = bins[:, f] <= b
            sides = [[weight[s & (y == c)].sum() for c in (0, 1)] for s in (left, ~left)]
            if min(map(sum, sides)) >= leaf:
                value = sum(sum(c * c for c in s) / sum(s) for s in sides)
                if value > own * (1 + 1e-12) and (best is None or value > best[0]):
                    best = (value, int(f), b, left)
    if best is None:
        return node, count
    keys = [trees._mix(key + np.uint64(c)) for c in (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82B)]
    sides = [plain(bins[s], y[s], weight[s], k, leaf, depth + 1) for s, k in zip((best[3], ~best[3]), keys)]
    if all(len(s[0]) == 2 for s in sides) and len({s[1][1] > s[1][0] for s in sides}) == 1:
        return node, count
    return (*node, *best[1:3], sides[0][0], sides[1][0]), count


def nested(tree, at=0):
    node = (tree.rows[at], tree.counts[at, 1] / tree.rows[at])
    if tree.left[at] < 0:
        return node
    return (*node, tree.feature[at], tree.bin[at], nested(tree, tree.left[at]), nested(tree, tree.left[at] + 1))


def test_trees_grow_as_one_by_one_and_together(monkeypatch):
    _, y, _, z = table()
    leaves = [1, 3, 8]
    together = [trees.grow(z, 4, t, leaves, SEED, TAKE, forest.UNLIMITED) for t in range(4)]
    for t, found in enumerate(together):
        weight = np.random.default_rng([SEED, t]).poisson(1.0, len(z))
        key = trees._mix(np.array([SEED], np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(t + 1))
        for leaf, tree in zip(leaves, found):
            used = weight > 0
            assert nested(tree) == plain((z >> 1)[used], y[used], weight[used], key, leaf, 0)[0]
            assert tree.rows[tree.left < 0].min() >= leaf and tree.rows[0] == weight.sum()
    # the same when histograms and rows are taken in small parts
    monkeypatch.setattr(trees, "NODES", 3)
    monkeypatch.setattr(trees, "ROWS", 50)
    for t, found in enumerate(together):
        again = trees.grow(z, 4, t, leaves, SEED, TAKE, forest.UNLIMITED)
        assert all(nested(a) == nested(b) for a, b in zip(found, again))


def test_shares_of_all_stops_and_of_cut_trees():
    _, _, _, z = table()
    bins, depths, splits = z >> 1, [2, 5, 0, forest.UNLIMITED], [2, 12, 10_000]
    for tree in trees.grow(z, 4, 0, [1, 3], SEED, TAKE, forest.UNLIMITED):
        total = np.zeros((len(depths), len(z), len(splits)))
        trees.add_shares(tree, bins, depths, splits, total)
        for i, depth in enumerate(depths):
            for j, least in enumerate(splits):
                small = trees.cut(tree, depth, least)
                for row in range(0, len(z), 7):
                    at = level = 0
                    while tree.left[at] >= 0 and level < depth and tree.rows[at] >= least:
                        at = tree.left[at] + (bins[row, tree.feature[at]] > tree.bin[at])
                        level += 1
                    assert total[i, row, j] == tree.share[at]
                    own = 0
                    while small.left[own] >= 0:
                        own = small.left[own] + (bins[row, small.feature[own]] > small.bin[own])
                    assert small.share[own] == tree.share[at]


def test_a_bootstrap_without_rows_is_a_leaf_that_says_nothing():
    _, _, _, z = table()
    found = [trees.grow(z[:2], 4, t, [1], SEED, TAKE, forest.UNLIMITED)[0] for t in range(60)]
    empty = [t for t in found if t.rows[0] == 0]
    assert empty and all(t.left.tolist() == [-1] and t.share.tolist() == [0.0] for t in empty)
    assert forest._node_rows(0, empty[0], [np.zeros(0)] * 4).column(3).to_pylist() == [0.0]


def test_split_points_of_few_and_of_many_values():
    few = np.array([3.0, 1.0, 1.0, 2.0])
    assert trees.thresholds([trees.summary(few[:2]), trees.summary(few[2:])]).tolist() == [1.5, 2.5]
    assert not len(trees.thresholds([trees.summary(np.zeros(9))]))
    many = np.random.default_rng(1).exponential(size=40_000)
    got = trees.thresholds([trees.summary(p) for p in np.array_split(many, 7)])
    assert len(got) == trees.BINS - 1 and (np.diff(got) > 0).all()
    assert np.abs((many[:, None] <= got).mean(0) - np.arange(1, trees.BINS) / trees.BINS).max() < 0.004
    assert trees.binned(np.array([[1.5], [1.6], [9.0]]), [np.array([1.5, 2.5])]).ravel().tolist() == [0, 1, 2]


def test_auc_with_ties_and_one_class():
    rng = np.random.default_rng(2)
    score, label = rng.integers(0, 9, 300) / 4, (rng.random(300) < 0.3).astype(np.uint8)
    pos, neg = score[label == 1], score[label == 0]
    assert trees.auc(score, label) == pytest.approx(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)), abs=1e-12)
    assert trees.auc(score, np.zeros(300, np.uint8)) is None


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 4))
    y = (x[:, 0] * x[:, 1] + 0.5 * rng.normal(size=1500) > 0).astype(float)
    rows = [(i, float(a), i % 5, Vectors.dense(v)) for i, (a, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, ["customer_id", "label", "fold", "features"]).repartition(3).cache()


def test_the_grid_takes_a_few_jobs_a_fold(spark, train):
    """Jobs for each level of each forest made the time of a grid."""
    sc = spark.sparkContext
    sc.setJobGroup("forest-grid", "the whole grid")
    try:
        best, table = forest.cross_validate(train, churn.RF_GRID, 5, 42)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(table) == 72 and not any(np.isnan(a) for _, a in table)
    assert 5 <= len(sc.statusTracker().getJobIdsForGroup("forest-grid")) <= 30


def test_parts_without_a_chunk_of_trees(spark, train, monkeypatch):
    grid = {"depth": [3, None], "leaf": [1, 4], "split": [2], "trees": [2, 5]}
    want = forest.cross_validate(train, grid, 5, 42)
    deal = RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *a, **b: deal(self, max(n, 23), *a, **b))
    assert forest.cross_validate(train, grid, 5, 42) == want
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *a, **b: deal(self, 2, *a, **b))
    assert forest.cross_validate(train, grid, 5, 42) == want


def test_as_good_as_spark_ml_and_larger_tables_take_its_forests(spark, train, monkeypatch):
    grid = {"depth": [3, None], "leaf": [4], "split": [2, 30], "trees": [10, 20]}
    own = dict(forest.cross_validate(train, grid, 5, 42)[1])
    point = forest.Point(None, 4, 30, 20)
    model = forest.cut(spark, forest.grow(train, 20, 4, 42), point)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 10)
    theirs = dict(forest.cross_validate(train, grid, 5, 42)[1])
    assert own.keys() == theirs.keys() and own != theirs
    assert all(abs(own[p] - theirs[p]) < 0.03 for p in own if p.depth is None)
    assert abs(np.mean([own[p] - theirs[p] for p in own])) < 0.02
    other = forest.cut(spark, forest.grow(train, 20, 4, 42), point)
    assert np.allclose(model.featureImportances.toArray(), other.featureImportances.toArray(), atol=0.06)
    right = [m.transform(train).where(F.col("label") == F.col("prediction")).count() for m in (model, other)]
    assert abs(right[0] - right[1]) < 60
    assert model.getNumTrees == other.getNumTrees == 20 and model.numClasses == other.numClasses == 2
