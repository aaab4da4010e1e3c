"""Customer lifecycle stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import favg, money_sum, safe_div

# Stage labels and day thresholds (tenure, days inactive).
NEW = "New (0-3 months)"
GROWING = "Growing (3-6 months)"
EARLY_CHURN = "Early Churn Risk"
ESTABLISHED = "Established (6-12 months)"
DECLINING = "Declining"
MATURE = "Mature (12+ months)"
AT_RISK = "At Risk"
DORMANT = "Churned/Dormant"


def stage_expr(tenure: Column, inactive: Column) -> Column:
    """First-match rule on tenure and days since the last transaction."""
    return (
        F.when(tenure <= 90, NEW)
        .when(tenure <= 180, F.when(inactive <= 45, GROWING).otherwise(EARLY_CHURN))
        .when(tenure <= 365, F.when(inactive <= 45, ESTABLISHED).otherwise(DECLINING))
        .otherwise(F.when(inactive <= 45, MATURE).when(inactive <= 90, AT_RISK).otherwise(DORMANT))
    )


def lifecycle_stages(customer_features: DataFrame) -> DataFrame:
    """Per-customer stage (projection, no shuffle)."""
    return customer_features.select(
        "customer_id",
        stage_expr(F.col("customer_tenure_days"), F.col("days_since_last_transaction")).alias("lifecycle_stage"),
        "customer_tenure_days",
        "days_since_last_transaction",
    )


def lifecycle_summary(customer_features: DataFrame) -> DataFrame:
    """Per-stage count, revenue sum and mean, mean LTV, mean tenure."""
    st = stage_expr(F.col("customer_tenure_days"), F.col("days_since_last_transaction"))
    return customer_features.groupBy(st.alias("stage")).agg(
        F.count("customer_id").alias("customer_count"),
        money_sum("total_revenue").alias("total_revenue"),
        safe_div(money_sum("total_revenue"), F.count("total_revenue")).alias("avg_revenue"),
        favg("customer_ltv").alias("avg_ltv"),
        F.avg("customer_tenure_days").alias("avg_tenure_days"),
    )
