"""Batched k-means against single fits, and the silhouette's ends against all pairs of rows."""

import numpy as np
import pytest

from tidemark.operators import cluster


def table(spark, x):
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "customer_id long, recency double, frequency double, monetary double, RFM_total double").repartition(4)


def blobs(rng, sizes, spread, dim=4):
    middles = rng.normal(size=(len(sizes), dim)) * 3
    return np.concatenate([m + rng.normal(size=(n, dim)) * spread for m, n in zip(middles, sizes)])


def single_fit(x, centres, tolerance=cluster.TOLERANCE):
    while True:
        own = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        moved = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        shift = ((moved - centres) ** 2).sum()
        centres = moved
        if shift <= tolerance:
            return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


def all_pairs_silhouette(x, own):
    far = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        if mine.sum() < 2:
            out.append(0.0)
            continue
        a = far[i][mine].sum() / (mine.sum() - 1)
        b = min(far[i][own == c].mean() for c in set(own) if c != own[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def scaled(x):
    s = x.std(0)
    return np.where(s > 0, (x - x.mean(0)) / np.where(s > 0, s, 1), 0)


def test_fifty_fits_at_once_cost_what_single_fits_cost(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([blobs(rng, [120, 200, 60, 90], 0.9), np.repeat(rng.normal(size=(1, 4)), 150, 0)])
    points = cluster.scaled_points(table(spark, x))
    sample = cluster.sample_points(points)
    first = [cluster.first_centres(sample, k, np.random.default_rng([s, k])) for k in range(3, 8) for s in range(10)]
    jobs = []
    was, cluster._sums = cluster._sums, lambda p, sets: jobs.append(len(sets)) or was(p, sets)
    try:
        fits = cluster.fit_batched(points, first)
    finally:
        cluster._sums = was
    z = scaled(x)
    for f, c in zip(fits, first):
        centres, cost = single_fit(z, c)
        assert f.cost == pytest.approx(cost, rel=1e-6) and np.allclose(f.centres, centres, atol=1e-6)
    # one pass an iteration, and one that measures; finished sets drop out
    assert len(jobs) == max(f.iterations for f in fits) + 1 and jobs == sorted(jobs, reverse=True) and jobs[-1] < jobs[0] == 50


@pytest.mark.parametrize("seed,sizes,spread", [(2, [100, 150, 80], 0.5), (3, [60, 60, 60, 60, 60], 0.8), (4, [300, 40, 40, 20], 1.5)])
def test_k_and_silhouette_agree_with_all_pairs(spark, seed, sizes, spread):
    x = blobs(np.random.default_rng(seed), sizes, spread)
    clusters, sil = cluster.kmeans_clusters(table(spark, x), starts=4)
    z = scaled(x)
    points = cluster.scaled_points(table(spark, x))
    sample = cluster.sample_points(points)
    exact = {}
    for k in range(3, 8):
        first = [cluster.first_centres(sample, k, np.random.default_rng([cluster.SEED, k, s])) for s in range(4)]
        centres, _ = min((single_fit(z, c) for c in first), key=lambda t: t[1])
        exact[k] = all_pairs_silhouette(z, ((z[:, None] - centres) ** 2).sum(2).argmin(1))
    got = {r.k: r for r in sil.collect()}
    for k, s in exact.items():
        assert got[k].lower - 1e-9 <= s <= got[k].upper + 1e-9
        assert got[k].silhouette == pytest.approx(s, abs=0.02)
    best = max(exact, key=lambda k: (exact[k], -k))
    assert max(got.values(), key=lambda r: (r.silhouette, -r.k)).k == best
    assert clusters.select("cluster").distinct().count() == best


def test_edges(spark):
    same = np.ones((7, 4))
    clusters, sil = cluster.kmeans_clusters(table(spark, same), starts=2)
    assert clusters.count() == 7 and {r.silhouette for r in sil.collect()} == {0.0}
    clusters, sil = cluster.kmeans_clusters(table(spark, same[:0]), starts=2)
    assert clusters.count() == 0 and sil.count() == 5
    clusters, sil = cluster.kmeans_clusters(table(spark, np.arange(40).reshape(10, 4)), k=2)
    assert clusters.select("cluster").distinct().count() == 2 and sil.collect()[0].silhouette is None
