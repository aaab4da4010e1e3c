"""Distributed ranking, exact quantiles and binning.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task.  ``global_rank`` instead range-partitions on the full sort key (value
*and* id, so a value shared by a third of all rows is still split across
partitions), numbers rows inside each partition, and adds the count of all
earlier partitions.  The per-partition count table has one row per partition,
so broadcasting it is bounded by the partition count, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage_parquet

_PID_SHIFT = 33  # monotonically_increasing_id = (partition index << 33) + row index


def files_size(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (0 for data made in memory)."""
    by_dir: dict[str, set[str]] = {}
    for f in df.inputFiles():
        folder, _, name = f.rpartition("/")
        by_dir.setdefault(folder, set()).add(name)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for folder, names in by_dir.items():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for status in path.getFileSystem(conf).listStatus(path):
            if status.getPath().toUri().getRawPath().rpartition("/")[2] in names:
                total += status.getLen()
    return total


def range_partitions(df: DataFrame, partitions: int | None = None) -> int:
    """Partition count: explicit, else one for each advisory size of the files read."""
    if partitions:
        return partitions
    advisory = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    target = int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory))
    return max(1, -(-files_size(df) // max(target, 1)))


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based ``row_number()`` over the whole frame in ``order``.

    ``order`` must be a total order (end it with a unique id) so the rank is
    deterministic.  Equivalent to ``row_number().over(Window.orderBy(*order))``
    without the single-task window: one range exchange with an explicit
    partition count, rows numbered inside each partition and written once to
    the checkpoint folder (runs one job now), a per-partition count (P rows), and a broadcast of
    the P-row offset table.
    """
    cols = _sort_cols(order)
    p = range_partitions(df, partitions)
    # The numbered frame is written once to the shared checkpoint folder: the
    # positions become stored data (an executor loss cannot renumber them) and
    # the lineage is cut, so chained ranks do not multiply the plan.
    ranged = stage_parquet(
        df.repartitionByRange(p, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_gr_mid", F.monotonically_increasing_id())
        .withColumn("_gr_pid", F.shiftright(F.col("_gr_mid"), _PID_SHIFT))
        .withColumn("_gr_pos", F.col("_gr_mid") - F.shiftleft(F.col("_gr_pid"), _PID_SHIFT)),
        "rank",
    )
    counts = ranged.groupBy("_gr_pid").agg(F.count(F.lit(1)).alias("_gr_n"))
    # At most P rows: an unpartitioned window over them is bounded.
    offsets = counts.select(
        "_gr_pid",
        (F.sum("_gr_n").over(Window.orderBy("_gr_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_gr_off"),
    ).na.fill({"_gr_off": 0})
    return (
        ranged.join(F.broadcast(offsets), "_gr_pid", "left")
        .withColumn(out, (F.col("_gr_off") + F.col("_gr_pos") + 1).cast("long"))
        .drop("_gr_mid", "_gr_pid", "_gr_pos", "_gr_off")
    )


def global_dense_rank(
    df: DataFrame,
    value: str,
    group: str | None = None,
    descending: bool = True,
    out: str = "dense_rank",
    partitions: int | None = None,
) -> DataFrame:
    """``dense_rank()`` of ``value`` (optionally within ``group``) without a hot window.

    Rows are range-partitioned on (group, value) and the row itself, so neither a
    hot group nor a hot value is kept together; each row that differs from the
    one before it counts one, and prefix sums over the partitions carry the
    count on.  Nothing is joined back on the group or the value: the only joins
    are broadcasts of one row a partition and of the groups' first ranks.
    """
    keys = [F.col(group)] if group else []
    v = F.col(value)
    rest = [F.col(f"`{c}`") for c, t in df.dtypes if c not in (group, value) and not t.startswith(("map", "variant"))]
    order = [*keys, v.desc_nulls_last() if descending else v.asc_nulls_last(), *rest]
    ranged = stage_parquet(
        df.repartitionByRange(range_partitions(df, partitions), *order)
        .sortWithinPartitions(*order)
        .withColumn("_dr_mid", F.monotonically_increasing_id())
        .withColumn("_dr_pid", F.shiftright(F.col("_dr_mid"), _PID_SHIFT)),
        "dense",
    )
    cell = F.struct(*keys, v)
    w = Window.partitionBy("_dr_pid").orderBy("_dr_mid")
    before = F.lag(cell).over(w)
    local = ranged.withColumn("_dr_new", F.when(before.isNotNull() & before.eqNullSafe(cell), 0).otherwise(1)).withColumn(
        "_dr_local", F.sum("_dr_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    ends = local.groupBy("_dr_pid").agg(
        F.sum("_dr_new").alias("_n"), F.min_by(cell, "_dr_mid").alias("_first"), F.max_by(cell, "_dr_mid").alias("_last")
    )
    wp = Window.orderBy("_dr_pid")  # P rows
    goes_on = F.lag("_last").over(wp).eqNullSafe(F.col("_first")) & F.lag("_last").over(wp).isNotNull()
    offsets = ends.withColumn("_go", goes_on.cast("int")).select(
        "_dr_pid",
        (F.coalesce(F.sum("_n").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum("_go").over(wp.rowsBetween(Window.unboundedPreceding, 0))).alias("_off"),
    )
    ranked = local.join(F.broadcast(offsets), "_dr_pid").withColumn(out, F.col("_dr_local") + F.col("_off"))
    if group:
        # the first row of each group, and of each partition, in one array; then one entry a group
        head = F.lag(F.struct(group)).over(w).isNull() | ~F.lag(F.col(group)).over(w).eqNullSafe(F.col(group))
        heads = ranked.withColumn("_dr_head", head).where("_dr_head").agg(F.array_sort(F.collect_list(F.struct(F.col(out).alias("at"), F.col(group).alias("g")))).alias("_dr_all"))
        first = lambda x, i: (i == 0) | ~F.get(F.col("_dr_all"), i - 1)["g"].eqNullSafe(x["g"])
        ranked = ranked.crossJoin(F.broadcast(heads.select(F.filter("_dr_all", first).alias("_dr_heads"))))
        start = F.get(F.filter("_dr_heads", lambda h: h["g"].eqNullSafe(F.col(group))), F.lit(0))["at"]
        ranked = ranked.withColumn(out, F.col(out) - start + 1)
    return ranked.select(*df.columns, F.when(v.isNotNull(), F.col(out)).alias(out))


def exact_quantiles_many(df: DataFrame, wanted: dict[str, Sequence[float]]) -> DataFrame:
    """Exact linear-interpolated quantiles (``pandas.quantile``) of several columns, long form.

    Rows (column, k, p, value).  Nothing is sorted or written whole: one pass
    takes counts and approximate percentiles a little to both sides of each
    probability, a second counts the values below each such bracket and the
    distinct values inside it (map-side combined, so a hot value is one row),
    and a running count over a bracket's distinct values finds the exact ranks.
    A bracket holds at most about one in 1,250 of the rows; up to 50,000 rows it
    holds them all, since there the neighbouring ranks may lie outside.
    """
    eps, accuracy, few = 2e-4, 10_000, 50_000
    num = {c: F.col(f"`{c}`").cast("double") for c in wanted}
    good = {c: F.when(x.isNotNull() & ~F.isnan(x), x) for c, x in num.items()}
    spots = [(c, k, float(p)) for c, ps in wanted.items() for k, p in enumerate(ps)]
    aggs = []
    for i, (c, _, p) in enumerate(spots):
        lo, hi = max(0.0, p - eps), min(1.0, p + eps)
        aggs += [
            F.when((F.count(good[c]) <= few) | F.lit(lo == 0), F.min(good[c])).otherwise(F.percentile_approx(good[c], lo, accuracy)).alias(f"_a{i}"),
            F.when((F.count(good[c]) <= few) | F.lit(hi == 1), F.max(good[c])).otherwise(F.percentile_approx(good[c], hi, accuracy)).alias(f"_b{i}"),
            F.count(good[c]).alias(f"_n{i}"),
        ]
    brackets = df.agg(*aggs)  # one row
    cells = [
        F.struct(
            F.lit(i).alias("i"), good[c].alias("v"), F.col(f"_a{i}").alias("a"), F.col(f"_b{i}").alias("b"),
        )
        for i, (c, _, _) in enumerate(spots)
    ]
    x = df.select(*[F.col(f"`{c}`") for c in wanted]).crossJoin(F.broadcast(brackets)).select(F.explode(F.array(*cells)).alias("x")).select("x.*")
    x = x.where(F.col("v") <= F.col("b"))
    hist = x.groupBy("i", F.when(F.col("v") >= F.col("a"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    # values below the bracket are one row with a NULL value, which sorts first
    w = Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first())
    hist = hist.withColumn("end", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("c"))
    meta = brackets.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.lit(k).alias("k"), F.lit(p).alias("p"), F.col(f"_n{i}").alias("n")) for i, (c, k, p) in enumerate(spots)])).alias("m")
    ).select("m.*")
    h = (F.col("n") - 1).cast("double") * F.col("p")
    at = lambda pos: (F.col("start") <= pos) & (pos < F.col("end"))
    found = (
        hist.join(F.broadcast(meta), "i")
        .groupBy("i")
        .agg(F.max(F.when(at(F.floor(h)), F.col("v"))).alias("lo"), F.max(F.when(at(F.ceil(h)), F.col("v"))).alias("hi"), F.max(h - F.floor(h)).alias("fr"))
    )
    return meta.join(found, "i", "left").select("column", "k", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("fr")).alias("value"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """One-row frame of one column's exact quantiles: columns ``{prefix}0 .. {prefix}{k-1}``."""
    long = exact_quantiles_many(df, {col: probs})
    return long.agg(*[F.max(F.when(F.col("k") == i, F.col("value"))).alias(f"{prefix}{i}") for i in range(len(probs))])


def qcut_rank(rank: Column, n: Column, q: int) -> Column:
    """``pd.qcut(x.rank(method='first'), q, labels=1..q)`` from a 1-based rank.

    Bin k is the smallest k >= 1 with r <= 1 + (n-1)k/q, i.e.
    ceil(q(r-1)/(n-1)) in integer arithmetic.  ``ntile`` differs (n=7, q=5).
    """
    k = F.floor((F.lit(q) * (rank - 1) + n - 2) / F.greatest(n - 1, F.lit(1)))
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), k)).cast("int")


def qcut_value(x: Column, edges: Sequence[Column], labels: Sequence[int | str]) -> Column:
    """Right-closed bins on interior quantile edges; the first bin takes the minimum.

    With duplicate edges pandas raises; here the first matching edge wins.
    A NULL value yields NULL.
    """
    assert len(labels) == len(edges) + 1
    out = None
    for e, lab in zip(edges, labels[:-1]):
        out = F.when(x <= e, F.lit(lab)) if out is None else out.when(x <= e, F.lit(lab))
    return out.when(x.isNotNull(), F.lit(labels[-1]))


def cut_right(x: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """``pd.cut(x, edges, labels)``: right-closed bins (lo, hi]; NULL outside.

    ``include_lowest=True`` also puts x == edges[0] in the first bin.
    """
    assert len(labels) == len(edges) - 1
    out = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def global_cumsum(
    df: DataFrame,
    order: Sequence[Column | str],
    values: Sequence[str],
    suffix: str = "_cum",
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``values`` over the whole frame in ``order`` (a total order).

    Same scheme as ``global_rank``: range partitions numbered and
    staged, running sums inside each partition (a window over one
    balanced range partition), plus the exclusive prefix of the per-partition
    totals (P rows, broadcast).  Replaces ``sum().over(Window.orderBy(...))``
    on tables that are not bounded.
    """
    cols = _sort_cols(order)
    p = range_partitions(df, partitions)
    ranged = stage_parquet(
        df.repartitionByRange(p, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_gc_mid", F.monotonically_increasing_id())
        .withColumn("_gc_pid", F.shiftright(F.col("_gc_mid"), _PID_SHIFT)),
        "cumsum",
    )
    w = Window.partitionBy("_gc_pid").orderBy("_gc_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged
    for v in values:
        local = local.withColumn(f"_gc_l_{v}", F.sum(v).over(w))
    tot = ranged.groupBy("_gc_pid").agg(*[F.sum(v).alias(f"_gc_t_{v}") for v in values])
    wp = Window.orderBy("_gc_pid").rowsBetween(Window.unboundedPreceding, -1)  # P rows
    offs = tot.select("_gc_pid", *[F.coalesce(F.sum(f"_gc_t_{v}").over(wp), F.lit(0)).alias(f"_gc_o_{v}") for v in values])
    out = local.join(F.broadcast(offs), "_gc_pid", "left")
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_gc_o_{v}") + F.col(f"_gc_l_{v}"))
    return out.drop("_gc_mid", "_gc_pid", *[f"_gc_l_{v}" for v in values], *[f"_gc_o_{v}" for v in values])


def exact_quantiles_bounded(df: DataFrame, col: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """Exact linear quantiles for a column with few distinct values (days, scores).

    Same result as ``exact_quantiles`` but from a histogram: one partial
    aggregate per distinct value, then a running count over the distinct
    values.  Only for columns whose distinct values are bounded by
    construction (e.g. day counts within the calendar span), because the
    running count is a window over the histogram.
    """
    v = F.col(col).cast("double")
    hist = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(v.alias("_q_v")).agg(F.count(F.lit(1)).alias("_q_c"))
    w = Window.orderBy("_q_v").rowsBetween(Window.unboundedPreceding, 0)  # bounded: one row per distinct value
    hist = hist.withColumn("_q_end", F.sum("_q_c").over(w)).withColumn("_q_start", F.col("_q_end") - F.col("_q_c"))
    n = hist.agg(F.sum("_q_c").alias("_q_n"))
    h = hist.crossJoin(F.broadcast(n))
    aggs = []
    for i, p in enumerate(probs):
        hh = (F.col("_q_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(hh), F.ceil(hh)
        at = lambda pos: (F.col("_q_start") <= pos) & (pos < F.col("_q_end"))
        aggs += [
            F.max(F.when(at(lo), F.col("_q_v"))).alias(f"_lo{i}"),
            F.max(F.when(at(hi), F.col("_q_v"))).alias(f"_hi{i}"),
            F.max(hh - lo).alias(f"_fr{i}"),
        ]
    picked = h.agg(*aggs)
    return picked.select(
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(f"{prefix}{i}")
            for i in range(len(probs))
        ]
    )
