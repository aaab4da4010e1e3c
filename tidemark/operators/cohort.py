"""Signup cohorts: counts, retention, average retention, cohort revenue.

Everything is kept in long form (cohort, cohort_index, value); ``to_matrix``
pivots for export.  The matrix is cohorts x month offsets, bounded by the
calendar, not by the data, so the spine and its windows stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_diff, month_label, month_start
from tidemark.functions.core import favg, money_sum, safe_div, scalar_join, share_pct
from tidemark.operators.features import customer_months


def with_cohort(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed activity per (customer, month) with signup cohort and month offset.

    The fact table is first reduced to one row per customer and month
    (revenue, transaction count) by a partial aggregate, so the join with
    customers moves customer-months, not transactions, and a customer with a
    third of all rows is already collapsed map-side.  Rows whose customer has
    no signup month are dropped, as pandas drops NaN group keys.
    """
    per_month = customer_months(transactions).select("customer_id", F.col("month").alias("_txn_m"), "revenue", "transactions")
    coh = customers.select("customer_id", month_start(F.col("signup_date")).alias("_cohort_m"))
    return (
        per_month.join(coh, "customer_id", "inner")
        .where(F.col("_cohort_m").isNotNull())
        .withColumn("cohort", month_label(F.col("_cohort_m")))
        .withColumn("cohort_index", month_diff(F.col("_txn_m"), F.col("_cohort_m")).cast("int"))
    )


def cohort_counts(cohorted: DataFrame) -> DataFrame:
    """Distinct active customers per (cohort, month offset).

    ``cohorted`` has one row per customer and month, so a plain count is the
    distinct count.
    """
    return cohorted.groupBy("cohort", "cohort_index").agg(F.count(F.lit(1)).alias("customers"))


def _spine(counts: DataFrame) -> DataFrame:
    """Every (cohort, index) cell of the reference's pivot matrix (bounded: months x months)."""
    cohorts = counts.select("cohort").distinct()
    idx = counts.select("cohort_index").distinct()
    return cohorts.crossJoin(idx)


def cohort_retention(
    counts: DataFrame,
    base: str = "first_index",
    fill_zero: bool = True,
    cohort_sizes: DataFrame | None = None,
) -> DataFrame:
    """Retention % per cell = customers / base customers * 100.

    ``base``:
      * ``"first_index"`` — the reference: the matrix's *first column*
        (smallest offset of any cohort, often -1, so values exceed 100 %).
        ``fill_zero=True`` is variant A (missing cells and a missing base give
        0); ``fill_zero=False`` is variant B (cells are zero-filled first, a
        zero base gives NULL where pandas gives inf / NaN).
      * ``"month0"`` — offset 0 of each cohort.
      * ``"cohort_size"`` — distinct signups per cohort (``cohort_sizes``:
        cohort, size); the sound definition.
    """
    cells = _spine(counts).join(counts, ["cohort", "cohort_index"], "left")
    if base == "cohort_size":
        if cohort_sizes is None:
            raise ValueError("cohort_size base needs cohort_sizes")
        b = cohort_sizes.select("cohort", F.col("size").alias("_base"))
    else:
        first = F.lit(0) if base == "month0" else F.col("_first")
        anchor = counts.agg(F.min("cohort_index").alias("_first"))
        b = (
            scalar_join(counts, anchor)
            .where(F.col("cohort_index") == first)
            .select("cohort", F.col("customers").alias("_base"))
        )
    cells = cells.join(b, "cohort", "left")
    c = F.coalesce(F.col("customers"), F.lit(0)) if not fill_zero else F.col("customers")
    ret = safe_div(c, F.col("_base")) * 100
    if fill_zero:
        ret = F.coalesce(ret, F.lit(0.0))
    return cells.select("cohort", "cohort_index", ret.alias("retention"))


def average_retention(retention: DataFrame) -> DataFrame:
    """Mean retention per month offset over cohorts (NULL cells skipped)."""
    return retention.groupBy(F.col("cohort_index").alias("month")).agg(
        favg("retention").alias("avg_retention")
    )


def to_matrix(long: DataFrame, value: str, max_index: int | None = None, values: Sequence[int] | None = None) -> DataFrame:
    """Pivot long (cohort, cohort_index, value) to a cohort x offset matrix for export.

    ``values`` fixes the columns; otherwise they are the offsets that occur.
    """
    df = long if max_index is None else long.where(F.col("cohort_index") <= max_index)
    if values is None:
        values = sorted(r[0] for r in df.select("cohort_index").distinct().collect())  # bounded: month offsets
    return df.groupBy("cohort").pivot("cohort_index", values).agg(F.first(value)).orderBy("cohort")


def to_blocks(long: DataFrame, value: str, width: int = 12) -> DataFrame:
    """The cohort matrix folded to ``width`` columns: a row for each cohort and block of offsets that occurs.

    A row holds the offsets ``first_index`` .. ``first_index + width - 1`` in the columns
    ``m0`` .. ; an offset without a value is NULL.  The columns don't depend on the data and
    every offset has a cell, whatever the range of the offsets.
    """
    first = F.expr(f"cohort_index - pmod(cohort_index, {width})")
    cells = [F.max(F.when(F.expr(f"pmod(cohort_index, {width})") == k, F.col(value))).alias(f"m{k}") for k in range(width)]
    return long.groupBy("cohort", first.alias("first_index")).agg(*cells)


def retention_dashboard(retention: DataFrame, columns: int = 12) -> DataFrame:
    """The first ``columns`` offset columns of the matrix, in long form."""
    firsts = retention.select("cohort_index").distinct()
    w = Window.orderBy("cohort_index")  # bounded: one row per month offset
    keep = firsts.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= columns).drop("_k")
    return retention.join(F.broadcast(keep), "cohort_index", "inner")


def cohort_revenue(cohorted: DataFrame) -> DataFrame:
    """Revenue, customers, transactions and LTV per signup cohort."""
    per = cohorted.groupBy("cohort").agg(
        F.countDistinct("customer_id").alias("customers"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("transactions").alias("transactions"),
    )
    tot = cohorted.agg(F.sum("revenue").cast("double").alias("_tot"))
    w = Window.orderBy("cohort").rowsBetween(Window.unboundedPreceding, 0)  # bounded: one row per month
    return scalar_join(per, tot).select(
        "cohort",
        "customers",
        "total_revenue",
        "transactions",
        safe_div(F.col("total_revenue"), F.col("customers")).alias("avg_revenue_per_customer"),
        safe_div(F.col("transactions"), F.col("customers")).alias("avg_transactions_per_customer"),
        share_pct(F.col("total_revenue"), F.col("_tot")).alias("revenue_contribution_pct"),
        F.sum("customers").over(w).alias("cumulative_customers"),
        safe_div(F.col("total_revenue"), F.col("customers")).alias("cohort_ltv"),
    ).orderBy("cohort")


def cohort_revenue_overall(cohort_rev: DataFrame) -> DataFrame:
    """Overall row — cohorts, customers, revenue, mean cohort LTV."""
    return cohort_rev.agg(
        F.count(F.lit(1)).alias("total_cohorts"),
        F.sum("customers").alias("total_customers"),
        money_sum("total_revenue").alias("total_revenue"),
        favg("cohort_ltv").alias("avg_ltv"),
    )


def segmentation_metrics(rfm_b: DataFrame, cohorted: DataFrame, curve: DataFrame) -> DataFrame:
    """Nine metric/value rows of the segmentation module (retention default 0)."""
    r = rfm_b.agg(
        F.count(F.lit(1)).cast("double").alias("total_customers"),
        money_sum("monetary").alias("total_revenue"),
        F.avg("recency").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        safe_div(money_sum("monetary"), F.count("monetary")).alias("avg_monetary"),
        F.countDistinct("rfm_segment").cast("double").alias("num_segments"),
    )
    c = cohorted.agg(F.countDistinct("cohort").cast("double").alias("num_cohorts"))
    m = curve.agg(
        F.coalesce(F.max(F.when(F.col("month") == 1, F.col("avg_retention"))), F.lit(0.0)).alias("avg_retention_month1"),
        F.coalesce(F.max(F.when(F.col("month") == 6, F.col("avg_retention"))), F.lit(0.0)).alias("avg_retention_month6"),
    )
    names = [
        "total_customers",
        "total_revenue",
        "avg_recency",
        "avg_frequency",
        "avg_monetary",
        "num_segments",
        "num_cohorts",
        "avg_retention_month1",
        "avg_retention_month6",
    ]
    one = r.crossJoin(c).crossJoin(m)  # three 1-row frames
    stack = ", ".join(f"'{n}', {n}" for n in names)
    return one.select(F.expr(f"stack({len(names)}, {stack}) AS (metric, value)"))


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """Distinct signups per cohort month (the ``cohort_size`` retention base)."""
    return (
        customers.where(F.col("signup_date").isNotNull())
        .groupBy(month_label(month_start(F.col("signup_date"))).alias("cohort"))
        .agg(F.countDistinct("customer_id").alias("size"))
    )
