"""Cleaning, customer / transaction features and revenue time tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tidemark.functions.calendar import month_label, month_start
from tidemark.functions.core import flag, money, money_avg, money_sum, safe_div, scalar_join
from tidemark.functions.ranking import exact_quantiles

# The statuses a transaction may carry after cleaning.
VALID_STATUSES = ["Completed", "Failed", "Pending", "Refunded"]

CUSTOMER_COLS = ["customer_id", "signup_date", "country", "industry", "subscription_type", "monthly_fee"]
TXN_COLS = ["transaction_id", "customer_id", "transaction_date", "amount", "payment_method", "transaction_status"]


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keyed dedup keeping the first row in ``order`` (a total order over the columns).

    Implemented as ``min(struct(order...))`` per key: the aggregate combines
    map-side, so a key repeated a billion times never reaches one task whole
    (a ``row_number`` window over ``partitionBy(key)`` would).
    """
    others = [c for c in order if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_first"))
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in others])
    )


def dedup_customers(customers: DataFrame) -> DataFrame:
    """D1, first half: one row per customer_id (keep-first in column order)."""
    return keep_first(customers.select(*CUSTOMER_COLS), "customer_id", CUSTOMER_COLS)


def impute_monthly_fee(first: DataFrame) -> DataFrame:
    """D1, second half: a missing monthly_fee becomes the exact median (after dedup, as in the reference)."""
    med = exact_quantiles(first, "monthly_fee", [0.5], prefix="_med")
    return scalar_join(first, med).select(
        *[c for c in CUSTOMER_COLS if c != "monthly_fee"],
        F.coalesce(F.col("monthly_fee").cast("double"), F.col("_med0")).alias("monthly_fee"),
    ).select(*CUSTOMER_COLS)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Dedup on customer_id, then fill a missing monthly_fee with the median."""
    return impute_monthly_fee(dedup_customers(customers))


def _numeric_amount(df: DataFrame) -> F.Column:
    t = df.schema["amount"].dataType
    if isinstance(t, StringType):
        return F.expr("try_cast(trim(amount) AS DOUBLE)")
    if isinstance(t, NumericType):
        return F.col("amount").cast("double")
    raise TypeError(f"amount must be numeric or text, got {t}")


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Dedup on transaction_id, coerce amount, drop null/NaN, keep valid statuses."""
    order = ["transaction_id", "transaction_date", "customer_id", "amount", "payment_method", "transaction_status"]
    first = keep_first(transactions.select(*TXN_COLS), "transaction_id", order)
    amt = _numeric_amount(first)
    return (
        first.withColumn("amount", amt)
        .where(F.col("amount").isNotNull() & ~F.isnan("amount"))
        .where(F.col("transaction_status").isin(VALID_STATUSES))
        .select(*TXN_COLS)
    )


def reference_date(transactions: DataFrame, name: str = "reference_date", plus_days: int = 0) -> DataFrame:
    """One-row frame: latest transaction date (all statuses), optionally shifted."""
    d = F.max("transaction_date")
    return transactions.agg((F.date_add(d, plus_days) if plus_days else d).alias(name))


CUSTOMER_MONTH_COLS = ["customer_id", "month", "revenue", "transactions", "last_date"]


def customer_months(transactions: DataFrame) -> DataFrame:
    """Completed activity, one row per (customer, month): exact revenue, transactions, last date.

    The one shuffle of the fact by customer that RFM, cohorts, verified revenue
    and the keyed series share; a customer with a third of all rows collapses
    map-side.  A table that already has these columns is returned as it is.
    """
    if set(CUSTOMER_MONTH_COLS) <= set(transactions.columns):
        return transactions
    return (
        transactions.where(F.col("transaction_status") == "Completed")
        .groupBy("customer_id", month_start(F.col("transaction_date")).alias("month"))
        .agg(
            F.sum(money(F.col("amount"))).alias("revenue"),
            F.count("transaction_id").alias("transactions"),
            F.max("transaction_date").alias("last_date"),
        )
    )


def customer_features(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per-customer transaction metrics and derived features (21 columns).

    One conditional aggregate (a single shuffle of transactions on
    customer_id) replaces the reference's three group-bys; the reference date
    is a 1-row scalar join.  Numeric NULLs become 0 as in the reference
    (a customer without transactions gets recency 0 and is_churned 0).
    """
    a = money(F.col("amount"))
    metrics = transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum(a).alias("_s1"),
        F.count("amount").alias("_na"),
        F.stddev_samp("amount").alias("std_transaction"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"),
        F.count_if(F.col("transaction_status") == "Completed").alias("successful_transactions"),
        F.count_if(F.col("transaction_status") == "Failed").alias("failed_transactions"),
    )
    metrics = metrics.select(
        "customer_id",
        "total_transactions",
        F.col("_s1").cast("double").alias("total_revenue"),
        safe_div(F.col("_s1").cast("double"), F.col("_na")).alias("avg_transaction"),
        "std_transaction",
        "first_transaction",
        "last_transaction",
        "successful_transactions",
        "failed_transactions",
    )
    ref = reference_date(transactions, "_ref")
    df = scalar_join(customers.join(metrics, "customer_id", "left"), ref)
    tenure = F.datediff(F.col("_ref"), F.col("signup_date"))
    recency = F.datediff(F.col("_ref"), F.col("last_transaction"))
    df = (
        df.withColumn("customer_tenure_days", tenure)
        .withColumn("days_since_last_transaction", recency)
        .withColumn(
            "transaction_frequency",
            safe_div(F.col("total_transactions"), F.col("customer_tenure_days") + 1) * 30,
        )
        .withColumn(
            "payment_failure_rate",
            safe_div(F.coalesce("failed_transactions", F.lit(0)), F.col("total_transactions") + 1),
        )
        .withColumn(
            "avg_monthly_revenue",
            safe_div(F.col("total_revenue"), F.col("customer_tenure_days") / 30 + 1),
        )
        .withColumn("is_churned", flag(F.col("days_since_last_transaction") > 60))
        .withColumn("customer_ltv", F.col("total_revenue"))
    )
    fill_long = ["total_transactions", "successful_transactions", "failed_transactions"]
    fill_int = ["customer_tenure_days", "days_since_last_transaction"]
    fill_dbl = [
        "total_revenue",
        "avg_transaction",
        "std_transaction",
        "transaction_frequency",
        "payment_failure_rate",
        "avg_monthly_revenue",
        "customer_ltv",
        "monthly_fee",
    ]
    df = df.na.fill(0, subset=fill_long + fill_int).na.fill(0.0, subset=fill_dbl)
    return df.select(
        *CUSTOMER_COLS,
        F.col("total_transactions").cast("long"),
        "total_revenue",
        "avg_transaction",
        "std_transaction",
        "first_transaction",
        "last_transaction",
        F.col("successful_transactions").cast("long"),
        F.col("failed_transactions").cast("long"),
        "customer_tenure_days",
        "days_since_last_transaction",
        "transaction_frequency",
        "payment_failure_rate",
        "avg_monthly_revenue",
        "is_churned",
        "customer_ltv",
    )


def transaction_features(transactions: DataFrame) -> DataFrame:
    """D3: calendar and flag columns (pure projection, no shuffle)."""
    d = F.col("transaction_date")
    dow = F.weekday(d)  # Monday = 0, as pandas dayofweek
    dom = F.dayofmonth(d)
    return transactions.select(
        *TXN_COLS,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        dow.alias("day_of_week"),
        dom.alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        flag(dow >= 5).alias("is_weekend"),
        flag(dom <= 5).alias("is_month_start"),
        flag(dom >= 25).alias("is_month_end"),
        flag(F.col("transaction_status") == "Completed").alias("is_successful"),
        flag(F.col("amount") > 0).alias("is_revenue"),
    )


def _completed(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("transaction_status") == "Completed")


def daily_revenue(transactions: DataFrame) -> DataFrame:
    """Completed revenue and count per day."""
    return (
        _completed(transactions)
        .groupBy(F.col("transaction_date").alias("date"))
        .agg(money_sum("amount").alias("revenue"), F.count("transaction_id").alias("transaction_count"))
    )


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Completed revenue, count and distinct customers per calendar month."""
    d = F.col("transaction_date")
    return (
        _completed(transactions)
        .groupBy(F.year(d).alias("year"), F.month(d).alias("month"))
        .agg(
            money_sum("amount").alias("revenue"),
            F.count("transaction_id").alias("transaction_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .withColumn("date", F.make_date("year", "month", F.lit(1)))
    )


def monthly_revenue_agg(raw_transactions: DataFrame) -> DataFrame:
    """Monthly Completed aggregate straight from *raw* transactions (no cleaning)."""
    amt = _numeric_amount(raw_transactions)
    return (
        raw_transactions.where(F.col("transaction_status") == "Completed")
        .withColumn("amount", amt)
        .groupBy(month_start(F.col("transaction_date")).alias("month"))
        .agg(
            money_sum("amount").alias("total_revenue"),
            F.count("amount").alias("transaction_count"),
            money_avg("amount").alias("avg_transaction"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def monthly_acquisitions(customers: DataFrame) -> DataFrame:
    """New customers per signup month ('yyyy-MM')."""
    return customers.groupBy(month_label(F.col("signup_date")).alias("signup_month")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
