"""Tables behind the reference's charts (C1-C7); drawing itself is not built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import fsum, money_sum, scalar_join
from tidemark.operators.profit import TIERS
from tidemark.operators.retention import RISK_LABELS


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max; the maximum goes in the last bin."""
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    b = F.least(F.expr(f"width_bucket({col}, _lo, _hi, {bins})"), F.lit(bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(b)
    counts = scalar_join(df.where(F.col(col).isNotNull()), mm).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return scalar_join(spine.join(counts, "bin", "left"), mm).select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * width).alias("bin_start"),
        (F.col("_lo") + F.col("bin") * width).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )


def rf_matrix(rfm: DataFrame) -> DataFrame:
    """Customer counts for every (R, F) score pair, zeros included."""
    r = rfm.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("R_score"))
    f = rfm.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("F_score"))
    c = rfm.groupBy("R_score", "F_score").agg(F.count(F.lit(1)).alias("customers"))
    return r.crossJoin(f).join(c, ["R_score", "F_score"], "left").na.fill(0, ["customers"])


def cohort_heatmap(retention: DataFrame, cohorts: int = 12, offsets: int = 12) -> DataFrame:
    """C4: the most recent ``cohorts`` cohorts x the first ``offsets`` month offsets."""
    last = retention.select("cohort").distinct().orderBy(F.desc("cohort")).limit(cohorts)
    first = retention.select("cohort_index").distinct().orderBy("cohort_index").limit(offsets)
    return retention.join(F.broadcast(last), "cohort").join(F.broadcast(first), "cohort_index")


def revenue_by(df: DataFrame, dim: str, value: str, top: int | None = None, out: str = "revenue") -> DataFrame:
    """Revenue per category, largest first (optionally the top k)."""
    g = df.groupBy(dim).agg(money_sum(value).alias(out)).orderBy(F.desc(out), dim)
    return g.limit(top) if top else g


def action_counts(recs: DataFrame, top: int = 5) -> DataFrame:
    """The most frequent specific recommendations."""
    return (
        recs.groupBy("specific_recommendation")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "specific_recommendation")
        .limit(top)
    )


def profit_by_tier(profit: DataFrame) -> DataFrame:
    """Total profit per tier in fixed tier order (absent tiers NULL)."""
    spine = profit.sparkSession.createDataFrame([(t, i) for i, t in enumerate(TIERS)], "tier string, tier_order int")
    per = profit.groupBy(F.col("profitability_tier").alias("tier")).agg(fsum("gross_profit").alias("total_profit"))
    return F.broadcast(spine).join(per, "tier", "left").orderBy("tier_order")


def risk_level_counts(predictions: DataFrame) -> DataFrame:
    """Customers per churn risk level in fixed order Low, Medium, High (0 when absent)."""
    spine = predictions.sparkSession.createDataFrame([(t, i) for i, t in enumerate(RISK_LABELS)], "risk_level string, risk_order int")
    per = predictions.groupBy(F.col("churn_risk_level").alias("risk_level")).agg(F.count(F.lit(1)).alias("customers"))
    return F.broadcast(spine).join(per, "risk_level", "left").na.fill(0, ["customers"]).orderBy("risk_order")
