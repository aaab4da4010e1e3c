"""Random forests for a whole grid, read off a few grown ones (M6).

A tree grown without limits holds the trees of every smaller depth and of every larger
least split size: stop at the depth, or at a node with too few rows, and answer with that
node's own class counts.  The first trees of a forest are a forest.  So a fold needs one
forest for each least leaf size, which does change how a tree grows; the other points
of the grid are read off it while its rows are scored once.  (Spark joins sibling leaves
of one prediction when it has grown a tree; what is read off has that, too.)

Up to ``LOCAL_ROWS`` rows, a byte a feature lets a task hold the table of a fold: tasks
then grow trees each (``operators.trees``), score the fold's rows at all points of the
grid and keep no tree.  Larger tables are grown by Spark ML, level by level over all rows.
"""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise, product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.blocks import numeric_blocks
from tidemark.operators import trees as local
from tidemark.operators.logistic import grouped_auc
from tidemark.session import scratch_path

#: Rows of a table that a task may hold with what it needs besides, some 120 bytes a row.
LOCAL_ROWS = 4_000_000
#: Spark's greatest depth, for trees that grow until their leaves are pure.
UNLIMITED = 30
#: Rows walked through a tree at once.
STEP = 8192


@dataclass(frozen=True)
class Point:
    """One point of the grid; ``depth`` None grows without a limit."""

    depth: int | None
    leaf: int
    split: int
    trees: int

    @property
    def max_depth(self) -> int:
        return UNLIMITED if self.depth is None else self.depth


def grid_points(grid: dict[str, Sequence]) -> list[Point]:
    """The points of a grid with the keys depth, leaf, split and trees, in that order of precedence."""
    return [Point(*p) for p in product(grid["depth"], grid["leaf"], grid["split"], grid["trees"])]


@dataclass
class Trees:
    """The nodes of a forest, tree after tree; a leaf has no ``left`` (-1).

    The model they come from is on the driver already, so they are no larger than what
    Spark ML holds there.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rows: np.ndarray
    share: np.ndarray


@dataclass
class Forest:
    """A forest without a limit on depth, still to be grown: its rows, least leaf size and seed say which trees it has."""

    train: DataFrame
    trees: int
    leaf: int
    seed: int

    def is_local(self) -> bool:
        return self.train.count() <= LOCAL_ROWS

    def estimator(self) -> RandomForestClassifier:
        return RandomForestClassifier(
            featuresCol="features", labelCol="label", numTrees=self.trees, maxDepth=UNLIMITED, minInstancesPerNode=self.leaf, seed=self.seed
        )


def grow(train: DataFrame, trees: int, leaf: int, seed: int) -> Forest:
    """A forest without a limit on depth; its inputs are ``label`` (0 or 1) and a vector of numbers, ``features``."""
    return Forest(train, trees, leaf, seed)


def _chunks(sizes: Sequence[int], tasks: int) -> list[tuple[int, int]]:
    """Runs of tree numbers, some ``tasks`` of them, that end at each of ``sizes``."""
    per = -(-max(sizes) // max(1, tasks))
    return [(lo, min(lo + per, b)) for a, b in pairwise(sorted({0, *sizes})) for lo in range(a, b, per)]


def _numbers(rows: DataFrame, features: int, held_out: bool) -> DataFrame:
    x = vector_to_array("features")
    return rows.select(F.col("label").cast("double").alias("label"), F.lit(float(held_out)).alias("held_out"), *[x[i].alias(f"x{i}") for i in range(features)])


def _split_points(blocks: RDD) -> list[np.ndarray]:
    """The split points of every feature, from the rows that are not held out."""

    def summed(part: int, found: Iterable[np.ndarray]) -> Iterator[tuple[int, list]]:
        x = [b[b[:, 1] == 0, 2:] for b in found]
        if sum(map(len, x)):
            yield part, [local.summary(v) for v in np.concatenate(x).T]

    # bounded: some hundred points a feature and part
    parts = [p for _, p in sorted(blocks.mapPartitionsWithIndex(summed).collect(), key=lambda p: p[0])]
    return [local.thresholds(of) for of in zip(*parts)]


def _in_tasks(forests: list[Forest], chunks: list[tuple[int, int]], work: Callable, held_out: DataFrame | None = None) -> tuple[RDD, RDD, list[np.ndarray]]:
    """What ``work(grow, rows held out, their labels, lo, hi)`` yields for each chunk of tree numbers.

    ``forests`` differ in their least leaf size only; ``grow(number)`` gives a tree for each of
    them.  Returns the blocks to let go afterwards, the results, and the split points.
    """
    first = forests[0]
    train, leaves, seed = first.train, [f.leaf for f in forests], first.seed
    dim = train.select(F.size(vector_to_array("features"))).first()[0]
    rows = _numbers(train, dim, False)
    if held_out is not None:
        rows = rows.union(_numbers(held_out, dim, True))
    blocks = numeric_blocks(rows, rows.columns)
    splits = _split_points(blocks)
    take = dim if first.trees == 1 else int(np.ceil(np.sqrt(dim)))

    def deal(part: int, found: Iterable[np.ndarray]) -> Iterator[tuple[int, tuple]]:
        for i, block in enumerate(found):
            z = 2 * local.binned(block[:, 2:], splits) + block[:, :1].astype(np.uint8)
            for held in (0, 1):
                if len(mine := z[block[:, 1] == held]):
                    piece = ((held, part, i), mine.tobytes())
                    for task in range(len(chunks)):
                        yield task, piece

    def run(pieces: Iterable[tuple[int, tuple]]) -> Iterator:
        held: dict[int, dict] = {}
        for task, (name, rows) in pieces:
            held.setdefault(task, {})[name] = rows
        for task in list(held):
            table, n = local.table_of(held.pop(task), dim)
            grown = lambda number, own=table[:n]: local.grow(own, dim, number, leaves, seed, take, UNLIMITED)
            yield from work(grown, table[n:] >> 1, table[n:, 0] & 1, *chunks[task])

    return blocks, blocks.mapPartitionsWithIndex(deal).partitionBy(len(chunks), int).mapPartitions(run), splits


def _grown(forest: Forest, trees: int, change: Callable[[local.Tree], local.Tree]) -> tuple[RDD, RDD, list[np.ndarray]]:
    """(number, changed tree) of the first ``trees`` trees."""

    def work(grown: Callable, held_out: np.ndarray, label: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, local.Tree]]:
        for number in range(lo, hi):
            yield number, change(grown(number)[0])

    return _in_tasks([forest], _chunks([trees], 2 * forest.train.sparkSession.sparkContext.defaultParallelism), work)


def _saved(spark: SparkSession, model: RandomForestClassificationModel) -> tuple[str, DataFrame]:
    """The model's saved form and its nodes as flat columns."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("id"),
        n["prediction"].alias("prediction"),
        n["impurity"].alias("impurity"),
        n["impurityStats"].alias("stats"),
        n["rawCount"].alias("rows"),
        n["gain"].alias("gain"),
        n["leftChild"].alias("left"),
        n["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"),
        split["leftCategoriesOrThreshold"].alias("threshold"),
        split["numCategories"].alias("categories"),
    )
    return path, nodes


def tree_nodes(spark: SparkSession, forest: Forest) -> Trees:
    if not forest.is_local():
        return _model_nodes(spark, forest.estimator().fit(forest.train))
    blocks, grown, splits = _grown(forest, forest.trees, lambda tree: tree)
    found = [tree for _, tree in sorted(grown.collect(), key=lambda t: t[0])]
    blocks.unpersist()
    roots = np.cumsum([0, *(len(t.left) for t in found)])[:-1]
    left = np.concatenate([np.where(t.left >= 0, t.left + root, -1) for t, root in zip(found, roots)])
    return Trees(
        roots=roots,
        feature=np.concatenate([t.feature for t in found]).astype(np.int64),
        threshold=np.concatenate([_thresholds(t, splits) for t in found]),
        left=left,
        right=np.where(left >= 0, left + 1, -1),
        rows=np.concatenate([t.rows for t in found]).astype(np.int64),
        share=np.concatenate([t.share for t in found]),
    )


def _thresholds(tree: local.Tree, splits: list[np.ndarray]) -> np.ndarray:
    """The split point of each inner node, 0 at leaves."""
    return np.array([splits[f][b] if left >= 0 else 0.0 for f, b, left in zip(tree.feature, tree.bin, tree.left)], float)


def _model_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> Trees:
    rows = _saved(spark, model)[1].orderBy("tree", "id").toPandas()
    if (rows["categories"] > 0).any():
        raise ValueError("only forests over numbers can be read, not over categories")
    tree = rows["tree"].to_numpy()
    roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    base = np.repeat(roots, np.diff(np.r_[roots, len(tree)]))
    child = lambda name: np.where(rows[name] >= 0, rows[name] + base, -1)
    stats = np.array([[s[0], s[1] if len(s) > 1 else 0.0] for s in rows["stats"]])
    return Trees(
        roots=roots,
        feature=rows["feature"].to_numpy(np.int64),
        threshold=np.array([t[0] if len(t) else 0.0 for t in rows["threshold"]]),
        left=child("left"),
        right=child("right"),
        rows=rows["rows"].to_numpy(np.int64),
        share=stats[:, 1] / stats.sum(1),
    )


def read_off(forest: Trees, x: np.ndarray, depths: Sequence[int], splits: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
    """Probability of class 1 for every row, depth, split size and number of trees: one walk a tree."""
    deep, least = np.array(depths)[None, :, None], np.array(splits)[None, None, :]
    total = np.zeros((len(x), len(depths), len(splits)))
    out = np.zeros((*total.shape, len(sizes)))
    for t, root in enumerate(forest.roots, 1):
        row, at = np.arange(len(x)), np.full(len(x), root)
        still = np.ones(total.shape, bool)
        level = 0
        while len(row):
            leaf = forest.left[at] < 0
            stop = still & (leaf[:, None, None] | (level >= deep) | (forest.rows[at][:, None, None] < least))
            total[row] += stop * forest.share[at][:, None, None]
            still &= ~stop
            on = still.any((1, 2))
            row, at, still = row[on], at[on], still[on]
            at = np.where(x[row, forest.feature[at]] <= forest.threshold[at], forest.left[at], forest.right[at])
            level += 1
        for i, size in enumerate(sizes):
            if size == t:
                out[..., i] = total / t
    return out


def cross_validate(train: DataFrame, grid: dict[str, Sequence], folds: int, seed: int, parallelism: int = 4) -> tuple[Point, list[tuple[Point, float]]]:
    """The point of best mean ROC AUC over the folds (a tie: the first of the grid), and (point, mean AUC).

    ``train`` has ``label``, ``fold`` and a vector of ``features``.  One forest is grown for
    each fold and leaf size, on the other folds; the fold's own rows are scored at all
    points by one walk through each.
    """
    points = grid_points(grid)
    mean = (_means if train.count() <= LOCAL_ROWS else _means_by_model)(train, grid, folds, seed, parallelism)
    table = [(p, float("nan") if mean.get(i) is None else float(mean[i])) for i, p in enumerate(points)]
    # twelve digits: equal rankings summed in another order are a tie
    best = max(range(len(points)), key=lambda i: (-1.0 if np.isnan(table[i][1]) else round(table[i][1], 12), -i))
    return points[best], table


def _means(train: DataFrame, grid: dict[str, Sequence], folds: int, seed: int, parallelism: int) -> dict[int, float]:
    """Mean ROC AUC of each point over the folds; a fold of one class has none and doesn't count."""
    spark = train.sparkSession
    depths = [UNLIMITED if d is None else d for d in grid["depth"]]
    splits, sizes, leaves = list(grid["split"]), list(grid["trees"]), list(grid["leaf"])
    chunks = _chunks(sizes, -(-6 * spark.sparkContext.defaultParallelism // folds))

    def work(grown: Callable, bins: np.ndarray, label: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, tuple]]:
        total = np.zeros((len(leaves), len(depths), len(bins), len(splits)))
        for number in range(lo, hi):
            for of, tree in zip(total, grown(number)):
                local.add_shares(tree, bins, depths, splits, of)
        for i, of in enumerate(total.reshape(-1, *total.shape[2:])):
            yield i, (lo, hi, label.tobytes(), of.tobytes())

    def judge(found: tuple[int, Iterable[tuple]]) -> Iterator[tuple[int, float | None]]:
        depth, leaf = found[0] % len(depths), found[0] // len(depths)
        total = 0.0
        for _, hi, label, share in sorted(found[1], key=lambda c: c[0]):
            total = total + np.frombuffer(share).reshape(-1, len(splits))
            for size in (j for j, s in enumerate(sizes) if s == hi):
                for split in range(len(splits)):
                    point = ((depth * len(leaves) + leaf) * len(splits) + split) * len(sizes) + size
                    yield point, local.auc(total[:, split], np.frombuffer(label, np.uint8))

    def one(fold: int) -> list[tuple[int, float | None]]:
        forests = [grow(train.where(F.col("fold") != fold), max(sizes), leaf, seed) for leaf in leaves]
        held_out = train.where(F.col("fold") == fold)
        blocks, sums, _ = _in_tasks(forests, chunks, work, held_out)
        # bounded: a number for each point
        found = sums.groupByKey(len(leaves) * len(depths)).flatMap(judge).collect()
        blocks.unpersist()
        return found

    with ThreadPool(min(parallelism, folds)) as pool:
        found = pool.map(inheritable_thread_target(spark)(one), range(folds), chunksize=1)
    by_point: dict[int, list[float]] = {}
    for point, auc in (x for of in found for x in of if x[1] is not None):
        by_point.setdefault(point, []).append(auc)
    return {point: float(np.mean(aucs)) for point, aucs in by_point.items()}


def _means_by_model(train: DataFrame, grid: dict[str, Sequence], folds: int, seed: int, parallelism: int) -> dict[int, float]:
    """The same with forests grown by Spark ML."""
    spark = train.sparkSession
    points = grid_points(grid)
    depths = [UNLIMITED if d is None else d for d in grid["depth"]]
    splits, sizes, leaves = list(grid["split"]), list(grid["trees"]), list(grid["leaf"])

    def one(task: tuple[int, int]) -> Trees:
        fold, leaf = task
        part = train.where(F.col("fold") != fold)
        return _model_nodes(spark, grow(part, max(sizes), leaf, seed).estimator().fit(part))

    tasks = list(product(range(folds), leaves))
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        grown = pool.map(inheritable_thread_target(spark)(one), tasks)
    forests = spark.sparkContext.broadcast(dict(zip(tasks, grown)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                x = np.array(part.column(2).to_pylist(), float)
                label, fold = part.column(0).to_numpy(), part.column(1).to_numpy()
                for f in np.unique(fold):
                    mine = fold == f
                    # rows, depth, leaf, split, trees: the order of the points
                    p = np.stack([read_off(forests.value[int(f), leaf], x[mine], depths, splits, sizes) for leaf in leaves], axis=2)
                    n = int(mine.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.tile(np.arange(len(points), dtype=np.int32), n)),
                            pa.array(np.full(n * len(points), f, np.int32)),
                            pa.array(p.reshape(-1)),
                            pa.array(np.repeat(label[mine], len(points))),
                        ],
                        names=["point", "fold", "score", "label"],
                    )

    rows = train.select(F.col("label").cast("double").alias("label"), F.col("fold").cast("int").alias("fold"), vector_to_array("features").alias("x"))
    auc = grouped_auc(rows.mapInArrow(score, "point int, fold int, score double, label double"), ["point", "fold"])
    # bounded: a row for each point; a fold of one class has no AUC and doesn't count
    mean = {r.point: r.auc for r in auc.groupBy("point").agg(F.avg("roc_auc").alias("auc")).collect()}
    forests.unpersist()
    return mean


def cut(spark: SparkSession, forest: Forest, point: Point) -> RandomForestClassificationModel:
    """The forest of ``point`` in ``forest``: its first trees, stopped at the depth and at nodes of too few rows.

    The trees are written in the saved form of a Spark ML model and loaded, so the result
    scores, saves and loads like any other.
    """
    return (_cut_local if forest.is_local() else _cut_model)(spark, forest, point)


NODES = (
    "tree int, id int, prediction double, impurity double, stats array<double>, rows bigint, gain double, left int, right int, "
    "feature int, threshold array<double>, categories int"
)


def _node_columns() -> list:
    """The flat columns of NODES as they stand in a saved model."""
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"), F.col("categories").alias("numCategories"))
    node = F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    return [F.col("tree").alias("treeID"), node.alias("nodeData")]


def _node_rows(number: int, tree: local.Tree, splits: list[np.ndarray]) -> pa.RecordBatch:
    """A tree's nodes with the columns of NODES."""
    rows, inner = tree.rows, tree.left >= 0
    impurity = np.where(rows > 0, 1 - (tree.counts**2).sum(1) / np.maximum(rows, 1) ** 2, 0.0)
    gain, at = np.full(len(rows), -1.0), tree.left[inner]
    gain[inner] = impurity[inner] - (rows[at] * impurity[at] + rows[at + 1] * impurity[at + 1]) / rows[inner]
    several = lambda values, each: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(each)], pa.int32()), pa.array(values))
    ints = lambda values: pa.array(values, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            ints(np.full(len(rows), number)),
            ints(np.arange(len(rows))),
            pa.array((tree.counts[:, 1] > tree.counts[:, 0]).astype(float)),
            pa.array(impurity),
            several(tree.counts.reshape(-1), np.full(len(rows), 2)),
            pa.array(rows.astype(np.int64)),
            pa.array(gain),
            ints(tree.left),
            ints(np.where(inner, tree.left + 1, -1)),
            ints(np.where(inner, tree.feature, -1)),
            several(_thresholds(tree, splits)[inner], inner.astype(int)),
            ints(np.full(len(rows), -1)),
        ],
        names=[c.split()[0] for c in NODES.split(", ")],
    )


def _about(spark: SparkSession, estimator, kind: str, **more) -> str:
    """The metadata line of a saved model."""
    params = {name: {p.name: v for p, v in found.items()} for name, found in (("paramMap", estimator._paramMap), ("defaultParamMap", estimator._defaultParamMap))}
    return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": estimator.uid, **params, **more})


def _cut_local(spark: SparkSession, forest: Forest, point: Point) -> RandomForestClassificationModel:
    depth, least = point.max_depth, point.split
    blocks, grown, splits = _grown(forest, point.trees, lambda tree: local.cut(tree, depth, least))

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, tree in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                yield _node_rows(number, pickle.loads(tree), splits)

    out = scratch_path(spark, "forest")
    packed = spark.createDataFrame(grown.map(lambda t: (t[0], pickle.dumps(t[1]))), "number int, tree binary")
    packed.mapInArrow(flat, NODES).select(*_node_columns()).write.parquet(f"{out}/data")
    blocks.unpersist()
    whole = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=point.trees, maxDepth=depth, minInstancesPerNode=forest.leaf, seed=forest.seed)
    single = DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=depth, minInstancesPerNode=forest.leaf, seed=forest.seed)
    of, kind = {"numFeatures": len(splits), "numClasses": 2}, "org.apache.spark.ml.classification."
    rows = [(i, _about(spark, single, f"{kind}DecisionTreeClassificationModel", **of), 1.0) for i in range(point.trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{out}/treesMetadata")
    about = _about(spark, whole, f"{kind}RandomForestClassificationModel", **of, numTrees=point.trees)
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return RandomForestClassificationModel.load(out)


def _cut_model(spark: SparkSession, forest: Forest, point: Point) -> RandomForestClassificationModel:
    path, nodes = _saved(spark, forest.estimator().fit(forest.train))
    depth_limit, least = point.max_depth, point.split

    def prune(tree: pd.DataFrame) -> pd.DataFrame:
        # a parent comes before its children, and ids count from 0 in that order
        tree = tree.sort_values("id").reset_index(drop=True)
        left, right = tree["left"].to_numpy().copy(), tree["right"].to_numpy().copy()
        rows = tree["rows"].to_numpy()
        depth, keep = np.zeros(len(tree), int), np.zeros(len(tree), bool)
        keep[0] = True
        for i in np.flatnonzero(left >= 0):
            depth[[left[i], right[i]]] = depth[i] + 1
            keep[[left[i], right[i]]] = keep[i] and depth[i] < depth_limit and rows[i] >= least
        stop = keep & (left >= 0) & ((depth >= depth_limit) | (rows < least))
        new = np.cumsum(keep) - 1
        inner = keep & (left >= 0) & ~stop
        tree["id"] = new
        tree["left"] = np.where(inner, new[left], -1)
        tree["right"] = np.where(inner, new[right], -1)
        tree["gain"] = np.where(stop, -1.0, tree["gain"])
        tree["feature"] = np.where(stop, -1, tree["feature"])
        tree["categories"] = np.where(stop, -1, tree["categories"])
        tree["threshold"] = [[] if s else t for s, t in zip(stop, tree["threshold"])]
        return tree[keep]

    kept = nodes.where(F.col("tree") < point.trees).groupBy("tree").applyInPandas(prune, nodes.schema)
    out = scratch_path(spark, "forest")
    kept.select(*_node_columns()).write.parquet(f"{out}/data")
    spark.read.parquet(f"{path}/treesMetadata").where(F.col("_1") < point.trees).write.parquet(f"{out}/treesMetadata")
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["numTrees"] = point.trees
    about["paramMap"]["maxDepth"] = point.max_depth
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return RandomForestClassificationModel.load(out)
