"""Customer profitability: verified revenue, cost model, profit, tiers, contribution.

All per-customer columns are projections over the customer table (no
shuffle); summaries are one group-by each plus 1-row totals joined by
broadcast.  Lookups (cost per tier) are literal maps inside the expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import favg, fsum, money_sum, safe_div, scalar_join, share_pct
from tidemark.functions.ranking import exact_quantiles
from tidemark.operators.features import customer_months

# The reference cost model.
ACQUISITION_COST = {"Basic": 50.0, "Professional": 100.0, "Enterprise": 200.0, "Premium": 300.0}
SUPPORT_COST_PER_MONTH = {"Basic": 5.0, "Professional": 15.0, "Enterprise": 40.0, "Premium": 75.0}
SERVICING_PCT = 0.15
TRANSACTION_FEE = 0.50
INFRASTRUCTURE_PCT = 0.05
PAYMENT_PROCESSING_PCT = 0.029

# Profitability tiers in display order (rank 0..3).
TIERS = ["Loss-Making", "Low Profit", "Medium Profit", "High Profit"]
COST_COLUMNS = [
    "acquisition_cost",
    "servicing_cost",
    "transaction_cost",
    "support_cost",
    "infrastructure_cost",
    "payment_processing_cost",
]
PERCENTILES = [25, 50, 75, 90, 95, 99]


def _lookup(col: Column, mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[col]


def verified_revenue(customer_features: DataFrame, transactions: DataFrame) -> DataFrame:
    """Completed revenue per customer (0 if none) replaces total_revenue."""
    rev = customer_months(transactions).groupBy("customer_id").agg(F.sum("revenue").cast("double").alias("verified_revenue"))
    df = customer_features.join(rev, "customer_id", "left").withColumn(
        "verified_revenue", F.coalesce(F.col("verified_revenue"), F.lit(0.0))
    )
    return df.withColumn("total_revenue", F.col("verified_revenue"))


def revenue_percentiles(profit_base: DataFrame) -> DataFrame:
    """Exact P25/50/75/90/95/99 of per-customer revenue (long form)."""
    q = exact_quantiles(profit_base, "total_revenue", [p / 100 for p in PERCENTILES], prefix="p")
    stack = ", ".join(f"{p}, p{i}" for i, p in enumerate(PERCENTILES))
    return q.select(F.expr(f"stack({len(PERCENTILES)}, {stack}) AS (percentile, value)"))


def customer_costs(df: DataFrame) -> DataFrame:
    """Six cost components and total_cost (unknown tier -> NULL costs)."""
    rev = F.col("total_revenue")
    sub = F.col("subscription_type")
    months = F.col("customer_tenure_days") / 30
    df = (
        df.withColumn("acquisition_cost", _lookup(sub, ACQUISITION_COST))
        .withColumn("servicing_cost", rev * F.lit(SERVICING_PCT))
        .withColumn("transaction_cost", F.col("total_transactions") * F.lit(TRANSACTION_FEE))
        .withColumn("support_cost", _lookup(sub, SUPPORT_COST_PER_MONTH) * months)
        .withColumn("infrastructure_cost", rev * F.lit(INFRASTRUCTURE_PCT))
        .withColumn("payment_processing_cost", rev * F.lit(PAYMENT_PROCESSING_PCT))
    )
    total = F.col(COST_COLUMNS[0])
    for c in COST_COLUMNS[1:]:
        total = total + F.col(c)
    return df.withColumn("total_cost", total)


def customer_profit(df: DataFrame) -> DataFrame:
    """D18 + D19: profit metrics, profitability tier and tier rank."""
    rev, cost = F.col("total_revenue"), F.col("total_cost")
    gp = rev - cost
    df = (
        df.withColumn("gross_profit", gp)
        .withColumn("profit_margin", F.when(rev > 0, F.col("gross_profit") / rev * 100).otherwise(F.lit(-100.0)))
        .withColumn(
            "monthly_profit", F.col("gross_profit") / F.greatest(F.col("customer_tenure_days") / 30, F.lit(1.0))
        )
        .withColumn("customer_roi", F.when(cost > 0, F.col("gross_profit") / cost * 100).otherwise(F.lit(0.0)))
        .withColumn(
            "profit_per_transaction",
            F.when(F.col("total_transactions") > 0, F.col("gross_profit") / F.col("total_transactions")).otherwise(
                F.lit(0.0)
            ),
        )
    )
    tier = (
        F.when(F.col("gross_profit") < 0, TIERS[0])
        .when(F.col("profit_margin") < 20, TIERS[1])
        .when(F.col("profit_margin") < 50, TIERS[2])
        .otherwise(TIERS[3])
    )
    return df.withColumn("profitability_tier", tier).withColumn(
        "tier_rank", _lookup(F.col("profitability_tier"), {t: i for i, t in enumerate(TIERS)}).cast("int")
    )


def profitability(customer_features: DataFrame, transactions: DataFrame) -> DataFrame:
    """D16-D19 composed: one row per customer with revenue, costs, profit and tier."""
    return customer_profit(customer_costs(verified_revenue(customer_features, transactions)))


def profit_tiers(profit: DataFrame) -> DataFrame:
    """Per-customer tier assignment with its rank."""
    return profit.select("customer_id", "gross_profit", "profit_margin", "profitability_tier", "tier_rank")


def cost_breakdown(profit: DataFrame) -> DataFrame:
    """Total per cost type and its share of all costs."""
    sums = profit.agg(*[fsum(c).alias(c) for c in COST_COLUMNS], fsum("total_cost").alias("_all"))
    stack = ", ".join(f"'{c}', {c}" for c in COST_COLUMNS)
    long = sums.select("_all", F.expr(f"stack({len(COST_COLUMNS)}, {stack}) AS (cost_type, total)"))
    return long.select("cost_type", "total", share_pct(F.col("total"), F.col("_all")).alias("pct_of_total_cost"))


def _totals(profit: DataFrame) -> DataFrame:
    return profit.agg(
        F.count(F.lit(1)).alias("_n"),
        money_sum("total_revenue").alias("_rev"),
        fsum("gross_profit").alias("_gp"),
    )


def profit_tier_summary(profit: DataFrame) -> DataFrame:
    """Per-tier sums, means and shares, in tier order."""
    per = profit.groupBy(F.col("profitability_tier").alias("tier")).agg(
        F.count("customer_id").alias("customer_count"),
        money_sum("total_revenue").alias("total_revenue"),
        fsum("total_cost").alias("total_cost"),
        fsum("gross_profit").alias("total_profit"),
        favg("profit_margin").alias("avg_margin"),
        favg("monthly_profit").alias("avg_monthly_profit"),
    )
    return (
        scalar_join(per, _totals(profit))
        .select(
            "tier",
            "customer_count",
            "total_revenue",
            "total_cost",
            "total_profit",
            "avg_margin",
            "avg_monthly_profit",
            share_pct(F.col("customer_count"), F.col("_n")).alias("customer_pct"),
            share_pct(F.col("total_revenue"), F.col("_rev")).alias("revenue_pct"),
            share_pct(F.col("total_profit"), F.col("_gp")).alias("profit_pct"),
            _lookup(F.col("tier"), {t: i for i, t in enumerate(TIERS)}).alias("_ord"),
        )
        .orderBy("_ord")
        .drop("_ord")
    )


def contribution(profit: DataFrame, dim: str) -> DataFrame:
    """Revenue vs profit contribution by one dimension, profit descending.

    ``dim`` in {"profitability_tier", "subscription_type", "country",
    "industry"}; the tier version has no mean margin, as in the reference.
    The count column keeps the reference's name ``customer_id``.
    """
    metrics = [
        F.count("customer_id").alias("customer_id"),
        money_sum("total_revenue").alias("total_revenue"),
        fsum("gross_profit").alias("gross_profit"),
    ]
    if dim != "profitability_tier":
        metrics.append(favg("profit_margin").alias("profit_margin"))
    per = profit.groupBy(dim).agg(*metrics)
    out = scalar_join(per, _totals(profit)).select(
        *per.columns,
        share_pct(F.col("total_revenue"), F.col("_rev")).alias("revenue_contribution_pct"),
        share_pct(F.col("gross_profit"), F.col("_gp")).alias("profit_contribution_pct"),
    )
    return out if dim == "profitability_tier" else out.orderBy(F.desc("gross_profit"), dim)


def _pct_text(x: Column) -> Column:
    return F.concat(F.regexp_replace(F.format_number(x, 1), ",", ""), F.lit("%"))


def _money_text(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(x, 2))


def profit_dashboard(profit: DataFrame) -> DataFrame:
    """Dashboard rows with display text and tenure in months (1 decimal, half-even)."""
    return profit.select(
        "customer_id",
        "country",
        "industry",
        "subscription_type",
        "total_revenue",
        "total_cost",
        "gross_profit",
        "profit_margin",
        "monthly_profit",
        "customer_roi",
        "profitability_tier",
        "customer_tenure_days",
        "total_transactions",
        _money_text(F.col("total_revenue")).alias("revenue_formatted"),
        _money_text(F.col("gross_profit")).alias("profit_formatted"),
        _pct_text(F.col("profit_margin")).alias("margin_formatted"),
        F.bround(F.col("customer_tenure_days") / 30, 1).alias("tenure_months"),
    )


def profit_kpis(profit: DataFrame) -> DataFrame:
    """Ten metric/value rows."""
    a = profit.agg(
        money_sum("total_revenue").alias("total_revenue"),
        fsum("total_cost").alias("total_cost"),
        fsum("gross_profit").alias("gross_profit"),
        (safe_div(fsum("gross_profit"), money_sum("total_revenue")) * 100).alias("overall_margin"),
        F.count(F.lit(1)).cast("double").alias("total_customers"),
        F.count_if(F.col("gross_profit") > 0).cast("double").alias("profitable_customers"),
        F.count_if(F.col("gross_profit") <= 0).cast("double").alias("loss_customers"),
        favg("gross_profit").alias("avg_profit_per_customer"),
        favg("monthly_profit").alias("avg_monthly_profit"),
        favg("customer_roi").alias("avg_roi"),
    )
    names = a.columns
    stack = ", ".join(f"'{n}', {n}" for n in names)
    return a.select(F.expr(f"stack({len(names)}, {stack}) AS (metric, value)"))


def top_profitable(profit: DataFrame, k: int = 10) -> DataFrame:
    """The k most profitable customers (ties by customer_id)."""
    return (
        profit.orderBy(F.desc("gross_profit"), "customer_id")
        .limit(k)
        .select("customer_id", "subscription_type", "gross_profit", "profit_margin")
    )


def top_losses(profit: DataFrame, k: int = 10) -> DataFrame:
    """The k largest losses among loss-making customers."""
    return (
        profit.where(F.col("gross_profit") < 0)
        .orderBy("gross_profit", "customer_id")
        .limit(k)
        .select("customer_id", "subscription_type", "gross_profit", "profit_margin")
    )


def tier_costs(profit: DataFrame) -> DataFrame:
    """Mean revenue and cost per tier in fixed tier order (absent tiers kept as NULL)."""
    spine = profit.sparkSession.createDataFrame([(t, i) for i, t in enumerate(TIERS)], "tier string, tier_order int")
    per = profit.groupBy(F.col("profitability_tier").alias("tier")).agg(
        favg("total_revenue").alias("avg_revenue"), favg("total_cost").alias("avg_cost")
    )
    return F.broadcast(spine).join(per, "tier", "left").orderBy("tier_order")
