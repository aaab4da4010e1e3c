"""Adapters: driver tables (TPC-H-like) -> canonical customers / transactions.

* customers: one row per ``customer``; signup = first order date; country =
  nation name; industry = market segment; subscription tier from the account
  balance; monthly_fee = max(balance, 0) / 10.
* transactions, three grains:
  A ``order_transactions``    one per order (status F/O/P),
  B ``lineitem_transactions`` one per line item (duplicate ids, refunds),
  C ``events_transactions``   one per event (most customers have none).

Dates arrive as TIMESTAMP_NTZ and are cast to DATE here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Subscription tiers by account-balance upper bound, and the
# payment-method names assigned to the five order priorities.
SUBSCRIPTION_BOUNDS = [(3300.0, "Basic"), (7300.0, "Professional"), (9300.0, "Enterprise")]
SUBSCRIPTION_TOP = "Premium"
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Credit Card",
    "2-HIGH": "Bank Transfer",
    "3-MEDIUM": "PayPal",
    "4-NOT SPECIFIED": "Wire Transfer",
    "5-LOW": "ACH",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _payment(priority: F.Column) -> F.Column:
    expr = None
    for k, v in PAYMENT_BY_PRIORITY.items():
        expr = F.when(priority == k, v) if expr is None else expr.when(priority == k, v)
    return expr.otherwise("Other")


def _subscription(balance: F.Column) -> F.Column:
    expr = None
    for bound, name in SUBSCRIPTION_BOUNDS:
        expr = F.when(balance < bound, name) if expr is None else expr.when(balance < bound, name)
    return expr.otherwise(SUBSCRIPTION_TOP)


def canonical_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Partial aggregate on orders: one row per customer leaves the map side.
    signup = (
        _read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.to_date("o_orderdate")).alias("signup_date"))
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(signup, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            "signup_date",
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("industry"),
            _subscription(F.col("c_acctbal")).alias("subscription_type"),
            (F.greatest(F.col("c_acctbal"), F.lit(0.0)) / F.lit(10.0)).alias("monthly_fee"),
        )
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A: one transaction per order."""
    o = _read(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .when(F.col("o_orderstatus") == "P", "Failed")
        .otherwise(F.col("o_orderstatus"))
    )
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
        _payment(F.col("o_orderpriority")).alias("payment_method"),
        status.alias("transaction_status"),
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: one transaction per line item; returned lines are refunds."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    gross = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    refunded = F.col("l_returnflag") == "R"
    status = (
        F.when(refunded, "Refunded")
        .when(F.col("l_linestatus") == "F", "Completed")
        .when(F.col("l_linestatus") == "O", "Pending")
        .otherwise(F.col("l_linestatus"))
    )
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("transaction_date"),
        F.when(refunded, -gross).otherwise(gross).alias("amount"),
        _payment(F.col("o_orderpriority")).alias("payment_method"),
        status.alias("transaction_status"),
    )


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter C: one transaction per event; purchase = Completed, error = Failed."""
    e = _read(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "purchase", "Completed").when(F.col("event_type") == "error", "Failed")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("transaction_date"),
        F.col("value").alias("amount"),
        F.lit("Credit Card").alias("payment_method"),
        status.otherwise("Pending").alias("transaction_status"),
    )


ADAPTERS = {"orders": order_transactions, "lineitem": lineitem_transactions, "events": events_transactions}


def load_canonical(spark: SparkSession, sf_dir: str, grain: str = "lineitem") -> tuple[DataFrame, DataFrame]:
    """(raw customers, raw transactions) for one driver-table grain."""
    return canonical_customers(spark, sf_dir), ADAPTERS[grain](spark, sf_dir)
