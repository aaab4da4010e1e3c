"""Distributed ranking / quantile primitives against single-task or numpy brute force."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.ranking import (
    cut_right,
    exact_quantiles,
    global_cumsum,
    global_dense_rank,
    global_rank,
    qcut_rank,
    qcut_value,
)


def _frame(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, v double")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5), min_size=1, max_size=60))
def test_global_rank_matches_single_partition_row_number(spark, values):
    df = _frame(spark, values)
    got = {r.id: r.rank for r in global_rank(df, ["v", "id"], partitions=4).collect()}
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rn")).collect()}
    assert got == want


def test_global_rank_hot_value_is_split(spark):
    # a third of the rows share one value: ties are split across range partitions by id
    vals = [7.0] * 300 + list(range(600))
    df = _frame(spark, vals)
    ranked = global_rank(df, ["v", "id"], partitions=6)
    got = sorted((r.v, r.id, r.rank) for r in ranked.collect())
    assert [g[2] for g in got] == list(range(1, len(vals) + 1))


def test_global_dense_rank_by_group(spark):
    rows = [(i, g, float(v)) for i, (g, v) in enumerate([("a", 3), ("a", 3), ("a", 1), ("b", 5), ("b", 2), ("a", 2)])]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = {r.id: r.dense_rank for r in global_dense_rank(df, "v", group="g").collect()}
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = {r.id: r.d for r in df.select("id", F.dense_rank().over(w).alias("d")).collect()}
    assert got == want


def test_global_cumsum_matches_window(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "id long, v double")
    got = {r.id: r.v_cum for r in global_cumsum(df, ["id"], ["v"], partitions=5).collect()}
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.select("id", F.sum("v").over(w).alias("c")).collect()}
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=50))
def test_exact_quantiles_match_numpy_linear(spark, values):
    probs = [0.0, 0.2, 0.25, 0.5, 0.8, 0.99, 1.0]
    row = exact_quantiles(_frame(spark, values), "v", probs).collect()[0]
    want = np.quantile(np.array(values), probs, method="linear")
    assert np.allclose([row[f"q{i}"] for i in range(len(probs))], want, rtol=1e-12, atol=1e-9)


def _pandas_qcut_rank(r, n, q):
    if n == 1:
        return 1
    for k in range(1, q + 1):
        if Fraction(r) <= 1 + Fraction(n - 1) * Fraction(k, q):
            return k
    return q


@pytest.mark.parametrize("q", [4, 5])
def test_qcut_rank_formula(spark, q):
    cases = [(r, n) for n in [1, 2, 3, 5, 7, 10, 13, 100] for r in range(1, n + 1)]
    df = spark.createDataFrame(cases, "r long, n long")
    got = [(x.r, x.n, x.k) for x in df.select("r", "n", qcut_rank(F.col("r"), F.col("n"), q).alias("k")).collect()]
    for r, n, k in got:
        assert k == _pandas_qcut_rank(r, n, q), (r, n, q)


def test_ntile_differs_from_qcut(spark):
    # n = 7, q = 5: pandas qcut of ranks gives bins 1,2,3,3,4,5,5 ... ntile gives 1,1,2,2,3,4,5
    df = spark.createDataFrame([(r, 7) for r in range(1, 8)], "r long, n long")
    ks = [x.k for x in df.orderBy("r").select(qcut_rank(F.col("r"), F.col("n"), 5).alias("k")).collect()]
    assert ks == [_pandas_qcut_rank(r, 7, 5) for r in range(1, 8)]


def test_qcut_value_right_closed_first_bin_takes_min(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    e = [F.lit(1.0), F.lit(2.0)]
    got = [r.b for r in df.select(qcut_value(F.col("x"), e, [3, 2, 1]).alias("b")).collect()]
    assert got == [3, 2, 1, None]


def test_cut_right_include_lowest(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.30001,), (0.6,), (1.0,)], "p double")
    edges, labels = [0.0, 0.3, 0.6, 1.0], ["Low", "Medium", "High"]
    strict = [r.l for r in df.select(cut_right(F.col("p"), edges, labels).alias("l")).collect()]
    lowest = [r.l for r in df.select(cut_right(F.col("p"), edges, labels, include_lowest=True).alias("l")).collect()]
    assert strict == [None, "Low", "Medium", "Medium", "High"]
    assert lowest == ["Low", "Low", "Medium", "Medium", "High"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=30), min_size=1, max_size=80))
def test_bounded_quantiles_equal_sorted_quantiles(spark, values):
    from tidemark.functions.ranking import exact_quantiles_bounded

    probs = [0.2, 0.4, 0.6, 0.8]
    df = _frame(spark, values)
    a = exact_quantiles(df, "v", probs).collect()[0]
    b = exact_quantiles_bounded(df, "v", probs).collect()[0]
    assert tuple(a) == tuple(b)


def test_descending_rank_and_cumsum_match_windows(spark):
    df = spark.createDataFrame([(i, float((i * 7) % 11)) for i in range(120)], "id long, v double")
    order = [F.col("v").desc(), F.col("id").desc()]
    got = {r.id: r.rank for r in global_rank(df, order, partitions=5).collect()}
    w = Window.orderBy(*order)
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    assert got == want
    cum = {r.id: r.v_cum for r in global_cumsum(df, order, ["v"], partitions=5).collect()}
    wc = w.rowsBetween(Window.unboundedPreceding, 0)
    want_c = {r.id: r.c for r in df.select("id", F.sum("v").over(wc).alias("c")).collect()}
    assert cum == want_c


def test_global_dense_rank_matches_window_on_hot_values(spark):
    rows = [(i, "abc"[i % 3], None if i % 11 == 0 else float(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, v double").repartition(5)
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = {r.id: r.d for r in df.where("v is not null").select("id", F.dense_rank().over(w).alias("d")).collect()}
    want |= {i: None for i, _, v in rows if v is None}
    for p in (1, 4, 13):
        got = {r.id: r.dense_rank for r in global_dense_rank(df, "v", group="g", partitions=p).collect()}
        assert got == want
    flat = {r.id: r.dense_rank for r in global_dense_rank(df, "v", descending=False, partitions=4).collect()}
    assert {flat[i] for i in flat if rows[i][2] == 0.0} == {1} and {flat[i] for i in flat if rows[i][2] == 6.0} == {7}


def test_dense_rank_deals_no_rows_by_group_or_value(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, "ab"[i % 2], float(i % 5)) for i in range(50)], "id long, risk string, v double")
        plan = global_dense_rank(df, "v", group="risk")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in plan.splitlines():
        assert "SortMergeJoin" not in line and "hashpartitioning(v" not in line and "hashpartitioning(risk" not in line


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.floats(-100, 100), st.just(3.5), st.none()), min_size=1, max_size=80))
def test_quantiles_of_many_columns_match_numpy(spark, values):
    from tidemark.functions.ranking import exact_quantiles_many

    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a double, b int")
    got = {(r.column, r.p): r.value for r in exact_quantiles_many(df, {"a": [0.0, 0.1, 0.5, 1.0], "b": [0.25]}).collect()}
    known = [v for v in values if v is not None]
    for p in (0.0, 0.1, 0.5, 1.0):
        if known:
            assert got["a", p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-12)
        else:
            assert got["a", p] is None
    assert got["b", 0.25] == pytest.approx(np.quantile(range(len(values)), 0.25))


def test_quantiles_do_not_sort_the_table(spark):
    from tidemark.functions.ranking import exact_quantiles_many

    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("x"))
    q = exact_quantiles_many(df, {"x": [0.5]})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert q.first().value == np.quantile([(i * 7919) % 100_003 for i in range(100_000)], 0.5)
