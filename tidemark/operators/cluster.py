"""Behavioural clusters on RFM (M11, M12): k-means with the Euclidean-silhouette choice of k.

All starts of all k are fitted together (``fit_batched``): one pass over the rows an
iteration assigns each row to every unfinished set of centres and adds partial sums in the
task, so the passes are the iterations of the slowest set, not the sum over the sets.

The silhouette is the Euclidean one, which needs all distances between rows.  Rows are
summed up in micro-clusters instead (count, sum and sum of squares for each cluster and
leaf of a k-d tree), and each row is compared with those.  For a row x and a
micro-cluster of mean m and mean square deviation s2 the mean distance lies between
|x - m| and sqrt(|x - m|^2 + s2), so the silhouette has a proven lower and upper end.  The
tree is refined until the ends of the best k part from the others': then the k chosen is
proven to be that of the full computation.  With ``MAX_LEAVES`` leaves and ends that still
overlap the estimate between them decides, and the table of scores shows the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.blocks import as_matrix, block_sum, numeric_blocks
from tidemark.functions.core import favg, money_sum, nan_to_zero
from tidemark.session import stage_parquet

# Cluster labels in order of descending mean RFM_total.
BEHAVIOURAL_LABELS = ["VIP Elite", "Engaged Regulars", "Growth Potential", "Casual Buyers", "Dormant", "At-Risk", "Lost"]
CLUSTER_FEATURES = ["recency", "frequency", "monetary", "RFM_total"]
SEED = 42
#: Rows that the first centres are drawn from, and that the k-d tree is built on.
SAMPLE_ROWS = 10_000
#: A set is finished when its centres move by less than this, in squares summed over the centres (variances are 1).
TOLERANCE, MAX_ITERATIONS = 1e-4, 300
#: Leaves of the k-d tree: the first number, and the last one tried where the choice of k isn't proven yet.
LEAVES, MAX_LEAVES = 256, 4096


def scaled_points(rfm: DataFrame, columns: Sequence[str] = CLUSTER_FEATURES, key: str = "customer_id") -> DataFrame:
    """(key, x0, x1, ...): standardised features (population deviation; a constant feature is 0), staged."""
    x = rfm.select(key, *[nan_to_zero(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    names = [f"x{i}" for i in range(len(columns))]
    row = x.agg(*[F.avg(n).alias(f"m{n}") for n in names], *[F.stddev_pop(n).alias(f"s{n}") for n in names])  # one row
    both = x.crossJoin(F.broadcast(row))
    scaled = [F.when(F.col(f"s{n}") > 0, (F.col(n) - F.col(f"m{n}")) / F.col(f"s{n}")).otherwise(0.0).alias(n) for n in names]
    return stage_parquet(both.select(key, *scaled), "cluster-points")


def sample_points(points: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SEED) -> np.ndarray:
    """At most ``rows`` points, those of least hash of their key: the same on every run."""
    names = points.columns[1:]
    least = points.orderBy(F.xxhash64(F.lit(seed), points.columns[0]), points.columns[0]).limit(rows)
    return np.array([tuple(r) for r in least.select(*names).collect()], float).reshape(-1, len(names))


def first_centres(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample: each next centre by its squared distance to the nearest one."""
    centres = [sample[rng.integers(len(sample))]]
    near = ((sample - centres[0]) ** 2).sum(1)
    for _ in range(k - 1):
        total = near.sum()
        at = int(np.searchsorted(np.cumsum(near), rng.random() * total)) if total > 0 else int(rng.integers(len(sample)))
        centres.append(sample[min(at, len(sample) - 1)])
        near = np.minimum(near, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


@dataclass
class Fit:
    """One set of centres; ``cost`` is the sum of squared distances to the nearest one."""

    centres: np.ndarray
    cost: float = float("inf")
    iterations: int = 0
    finished: bool = False

    @property
    def k(self) -> int:
        return len(self.centres)


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _sums(blocks: RDD, sets: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One pass: for each set the rows, coordinate sums by centre, and the cost."""
    bounds = np.cumsum([0] + [len(c) for c in sets])
    every = np.concatenate(sets)
    dim = every.shape[1]

    def run(parts: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((len(every), dim + 2))
        for x in parts:
            for lo in range(0, len(x), 4096):
                part = x[lo : lo + 4096]
                far = _square_distances(part, every)
                for a, b in zip(bounds, bounds[1:]):
                    own = far[:, a:b].argmin(1)
                    total[a:b, 0] += np.bincount(own, minlength=b - a)
                    for d in range(dim):
                        total[a:b, 1 + d] += np.bincount(own, part[:, d], b - a)
                    total[a:b, dim + 1] += np.bincount(own, far[np.arange(len(part)), a + own], b - a)
        return total

    # bounded: a few numbers for each centre
    got = block_sum(blocks, run)
    return [(got[a:b, 0], got[a:b, 1 : dim + 1], float(got[a:b, dim + 1].sum())) for a, b in zip(bounds, bounds[1:])]


def fit_batched(points: DataFrame, starts: list[np.ndarray], tolerance: float = TOLERANCE, max_iterations: int = MAX_ITERATIONS) -> list[Fit]:
    """Lloyd's iterations for all sets of first centres at once: one job an iteration.

    A finished set's cost is measured by the pass after its last move, then it drops out.
    A centre without rows stays where it is.
    """
    fits = [Fit(np.array(c, float)) for c in starts]
    todo = list(fits)
    blocks = numeric_blocks(points, points.columns[1:])
    while todo:
        for f, (n, sums, cost) in zip(todo, _sums(blocks, [f.centres for f in todo])):
            f.cost = cost
            if f.finished:
                continue
            f.iterations += 1
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], f.centres)
            shift = float(((moved - f.centres) ** 2).sum())
            f.centres = moved
            if shift <= tolerance or f.iterations >= max_iterations:
                f.finished, f.cost = True, float("nan")
        todo = [f for f in todo if not f.finished or np.isnan(f.cost)]
    blocks.unpersist()
    return fits


# ---- silhouette -------------------------------------------------------------


@dataclass
class Tree:
    """A k-d tree of 2 ** depth leaves: in each level the coordinate and the bound of each node."""

    axes: list[np.ndarray]
    bounds: list[np.ndarray]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for axis, bound in zip(self.axes, self.bounds):
            at = 2 * at + (x[np.arange(len(x)), axis[at]] > bound[at])
        return at


def build_tree(sample: np.ndarray, leaves: int) -> Tree:
    """Halves of the sample by the median of its widest coordinate."""
    parts, axes, bounds = [sample], [], []
    while len(parts) < leaves:
        axis = [int(np.ptp(p, 0).argmax()) if len(p) else 0 for p in parts]
        bound = [float(np.median(p[:, a])) if len(p) else 0.0 for p, a in zip(parts, axis)]
        axes.append(np.array(axis))
        bounds.append(np.array(bound))
        parts = [q for p, a, b in zip(parts, axis, bound) for q in (p[p[:, a] <= b], p[p[:, a] > b])]
    return Tree(axes, bounds)


def micro_clusters(points: DataFrame, sets: list[np.ndarray], tree: Tree) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each set of centres: cluster, rows, mean and mean square deviation of its micro-clusters.

    At most (leaves x k) for each set, whatever the number of rows.
    """
    names = points.columns[1:]
    dim = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            x = as_matrix(batch)
            leaf = tree.leaf(x)
            values = np.column_stack((np.ones(len(x)), x, (x * x).sum(1)))
            for s, centres in enumerate(sets):
                own = _square_distances(x, centres).argmin(1)
                keys, where = np.unique(own * (1 << 32) + leaf, return_inverse=True)
                part = np.column_stack([np.bincount(where, values[:, i], len(keys)) for i in range(dim + 2)])
                for key, v in zip(keys.tolist(), part):
                    at = (s, key >> 32, key & 0xFFFFFFFF)
                    sums[at] = sums[at] + v if at in sums else v
        table = np.array(list(sums.values())).reshape(-1, dim + 2)
        cols = [pa.array([k[i] for k in sums], pa.int64()) for i in range(3)] + [pa.array(table[:, i]) for i in range(dim + 2)]
        yield pa.RecordBatch.from_arrays(cols, names=["s", "cluster", "leaf", *[f"v{i}" for i in range(dim + 2)]])

    schema = "s bigint, cluster bigint, leaf bigint, " + ", ".join(f"v{i} double" for i in range(dim + 2))
    rows = (
        points.select(*names).mapInArrow(run, schema).groupBy("s", "cluster", "leaf").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(dim + 2)]).collect()
    )
    out = []
    for s in range(len(sets)):
        mine = sorted((r for r in rows if r.s == s), key=lambda r: (r.cluster, r.leaf))
        v = np.array([tuple(r)[3:] for r in mine]).reshape(-1, dim + 2)
        mean = v[:, 1 : dim + 1] / v[:, :1]
        spread = np.maximum(v[:, dim + 1] / v[:, 0] - (mean * mean).sum(1), 0)
        out.append((np.array([r.cluster for r in mine], np.int64), v[:, 0], mean, spread))
    return out


def _silhouettes(x: np.ndarray, own: np.ndarray, k: int, cluster, rows, mean, spread) -> np.ndarray:
    """Lower end, estimate and upper end of each row's silhouette, as columns."""
    dim = x.shape[1]
    size = np.bincount(cluster, rows, k)
    heads = np.searchsorted(cluster, np.arange(k))
    there = np.flatnonzero(size)
    square = _square_distances(x, mean)
    ends = []
    # the mean distance to a micro-cluster is at least that to its mean, at most the root of the mean square
    for share in (0.0, (dim - 1) / dim, 1.0):
        total = np.zeros((len(x), k))
        total[:, there] = np.add.reduceat(np.sqrt(square + share * spread) * rows, heads[there], axis=1)
        ends.append(total)
    at = np.arange(len(x))
    inside = [t[at, own] / np.maximum(size[own] - 1, 1) for t in ends]
    outside = []
    for t in ends:
        m = np.where(size > 0, t / np.maximum(size, 1), np.inf)
        m[at, own] = np.inf
        outside.append(m.min(1))

    def score(a, b):
        return np.where(np.maximum(a, b) > 0, (b - a) / np.where(np.maximum(a, b) > 0, np.maximum(a, b), 1), 0.0)

    out = np.column_stack((score(inside[2], outside[0]), score(inside[1], outside[1]), score(inside[0], outside[2])))
    # a row alone in its cluster scores 0, as do all rows of a single cluster
    out[(size[own] <= 1) | (len(there) < 2)] = 0.0
    return out


def silhouettes(points: DataFrame, sets: list[np.ndarray], tree: Tree) -> list[tuple[float, float, float]]:
    """Mean Euclidean silhouette of each set of centres: lower end, estimate, upper end."""
    names = points.columns[1:]
    shared = points.sparkSession.sparkContext.broadcast(micro_clusters(points, sets, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        micro = shared.value
        total = np.zeros((len(sets), 4))
        for batch in batches:
            x = as_matrix(batch)
            for s, centres in enumerate(sets):
                step = max(1, 1_000_000 // max(1, len(micro[s][1])))
                for lo in range(0, len(x), step):
                    part = x[lo : lo + step]
                    own = _square_distances(part, centres).argmin(1)
                    total[s, 0] += len(part)
                    total[s, 1:] += _silhouettes(part, own, len(centres), *micro[s]).sum(0)
        cols = [pa.array(np.arange(len(sets)))] + [pa.array(total[:, i]) for i in range(4)]
        yield pa.RecordBatch.from_arrays(cols, names=["s", "n", "low", "mid", "high"])

    rows = points.select(*names).mapInArrow(run, "s bigint, n double, low double, mid double, high double").groupBy("s").agg(*[F.sum(c).alias(c) for c in ("n", "low", "mid", "high")]).collect()
    by = {r.s: r for r in rows}
    return [(by[s].low / by[s].n, by[s].mid / by[s].n, by[s].high / by[s].n) if s in by and by[s].n else (0.0, 0.0, 0.0) for s in range(len(sets))]


def proven_silhouettes(points: DataFrame, sets: list[np.ndarray], sample: np.ndarray, leaves: int = LEAVES, max_leaves: int = MAX_LEAVES) -> list[tuple[float, float, float]]:
    """``silhouettes`` with a tree fine enough to prove which set is best, or of ``max_leaves`` leaves."""
    while True:
        got = silhouettes(points, sets, build_tree(sample, leaves))
        best = max(range(len(sets)), key=lambda s: (got[s][1], -s))
        if leaves >= max_leaves or all(got[best][0] > got[s][2] for s in range(len(sets)) if s != best):
            return got
        leaves *= 4


# ---- clusters ---------------------------------------------------------------


def kmeans_clusters(rfm: DataFrame, k: int | None = None, k_range=range(3, 8), starts: int = 10, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Standardised (recency, frequency, monetary, RFM_total) -> k-means.

    ``k=None`` picks k in ``k_range`` by the Euclidean silhouette, a tie goes to the smaller k.  Each k is
    fitted from ``starts`` seeds and the fit of lowest cost is kept.  Returns
    (customer_id, cluster), staged, and the table (k, silhouette, lower, upper), whose
    ends bound the silhouette over all pairs of rows; with ``k`` given it is empty of values.
    """
    spark = rfm.sparkSession
    points = scaled_points(rfm)
    sample = sample_points(points, seed=seed)
    sil = "k int, silhouette double, lower double, upper double"
    wanted = [k] if k is not None else list(k_range)
    if not len(sample):
        empty = points.select("customer_id", F.lit(0).alias("cluster"))
        return stage_parquet(empty, "clusters"), spark.createDataFrame([(kk, None, None, None) for kk in wanted], sil)
    first = [first_centres(sample, kk, np.random.default_rng([seed, kk, s])) for kk in wanted for s in range(starts)]
    fits = fit_batched(points, first)
    best = [min((f for f in fits if f.k == kk), key=lambda f: f.cost) for kk in wanted]
    if k is None:
        scores = proven_silhouettes(points, [f.centres for f in best], sample)
        pick = max(range(len(best)), key=lambda i: (scores[i][1], -wanted[i]))
        table = [(kk, mid, low, high) for kk, (low, mid, high) in zip(wanted, scores)]
    else:
        pick, table = 0, [(k, None, None, None)]
    centres = best[pick].centres

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _square_distances(as_matrix(batch, 1), centres).argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], names=["customer_id", "cluster"])

    kind = points.schema["customer_id"].dataType.simpleString()
    clusters = stage_parquet(points.mapInArrow(run, f"customer_id {kind}, cluster int"), "clusters")
    return clusters, spark.createDataFrame(table, sil)  # bounded: one row per tried k


def cluster_profile(rfm: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per-cluster count, means, revenue and the behavioural label by descending mean RFM_total."""
    prof = (
        rfm.join(clusters, "customer_id")
        .groupBy("cluster")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.avg("recency").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
            money_sum("monetary").alias("total_revenue"),
            favg("monetary").alias("avg_revenue"),
            F.avg("RFM_total").alias("avg_rfm_score"),
        )
    )
    labels = F.array(*[F.lit(x) for x in BEHAVIOURAL_LABELS])
    w = Window.orderBy(F.desc("avg_rfm_score"), "cluster")  # bounded: one row per cluster (k <= 7)
    return prof.withColumn("behavioral_segment", F.element_at(labels, F.row_number().over(w).cast("int")))


def rule_clusters(rfm: DataFrame) -> DataFrame:
    """(customer_id, cluster): a fixed grouping by RFM_total, where labels must not depend on a fitted model."""
    t = F.col("RFM_total")
    return rfm.select("customer_id", F.when(t >= 12, 0).when(t >= 9, 1).when(t >= 6, 2).otherwise(3).alias("cluster"))


def behavioural_segments(clusters: DataFrame, profile: DataFrame) -> DataFrame:
    """Per-customer behavioural label."""
    return clusters.join(F.broadcast(profile.select("cluster", "behavioral_segment")), "cluster", "left")
