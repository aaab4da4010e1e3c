"""RFM scoring, segment rules and segment summaries.

Two variants exist in the reference and both are kept:

* ``"A"`` (cohort/RFM module): reference date = latest transaction, labels
  of rule set A, column ``segment``.
* ``"B"`` (segmentation module): reference date = latest transaction + 1 day,
  labels of rule set B, column ``rfm_segment``, plus ``signup_date``.

Scores: R by value quantiles of recency (5 = most recent), F and M by
rank-first quantiles (ties broken by customer_id) — neither is ``ntile``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import money_sum, safe_div, scalar_join
from tidemark.functions.ranking import exact_quantiles_bounded, global_rank, qcut_rank, qcut_value
from tidemark.operators.features import customer_months, reference_date

# Rule set A, first match wins; thresholds on (r, f, m) scores.
RULES_A = [
    ("Champions", "r >= 4 AND f >= 4 AND m >= 4"),
    ("Loyal Customers", "r >= 4 AND f >= 3"),
    ("Potential Loyalists", "r >= 3 AND f >= 1 AND m >= 3"),
    ("New Customers", "r >= 4 AND f <= 2"),
    ("Promising", "r >= 3 AND f >= 3 AND m >= 2"),
    ("At Risk", "r <= 2 AND f >= 3"),
    ("Can't Lose", "r <= 2 AND f >= 4 AND m >= 4"),
    ("Hibernating", "r <= 2 AND f <= 2"),
    ("About to Sleep", "r <= 3 AND f <= 2"),
]
DEFAULT_A = "Need Attention"

# Rule set B, first match wins.
RULES_B = [
    ("Champions", "r >= 4 AND f >= 4 AND m >= 4"),
    ("Loyal Customers", "r >= 3 AND f >= 4 AND m >= 4"),
    ("Potential Loyalists", "r >= 4 AND f >= 2 AND m >= 2"),
    ("New Customers", "r >= 4 AND f <= 2"),
    ("Promising", "r >= 3 AND f >= 2 AND m >= 2"),
    ("Need Attention", "r >= 3 AND f >= 3 AND m <= 3"),
    ("About to Sleep", "r = 2 AND f <= 3"),
    ("At Risk", "r <= 2 AND f >= 3 AND m >= 3"),
    ("Cant Lose", "r <= 2 AND f >= 4 AND m >= 4"),
    ("Hibernating", "r <= 2 AND f <= 2"),
]
DEFAULT_B = "Lost"

# Segment descriptions and recommended actions of rule set B.
SEGMENT_TEXT_B = {
    "Champions": ("Best customers - high value, recent, frequent buyers", "Reward program, early access, referral program"),
    "Loyal Customers": ("Consistent customers with good engagement", "Upsell higher-value products, loyalty program"),
    "Potential Loyalists": ("Recent customers with good potential", "Onboarding support, membership offers"),
    "New Customers": ("Recently acquired customers", "Welcome series, product education"),
    "Promising": ("New shoppers with above-average activity", "Create brand awareness, free trials"),
    "Need Attention": ("Above-average but showing declining engagement", "Limited time offers, personalized outreach"),
    "About to Sleep": ("Below-average engagement, at risk of churning", "Re-engagement campaign, win-back offers"),
    "At Risk": ("High-value customers showing declining activity", "Personal outreach, special discounts"),
    "Cant Lose": ("Previously high-value, now inactive", "Win-back campaign, survey for feedback"),
    "Hibernating": ("Low engagement, been inactive for a while", "Re-activation campaign, special offers"),
    "Lost": ("Lowest engagement, likely churned", "Ignore or minimal effort reactivation"),
}

VARIANTS = {
    "A": {"plus_days": 0, "rules": RULES_A, "default": DEFAULT_A, "col": "segment", "extra": []},
    "B": {"plus_days": 1, "rules": RULES_B, "default": DEFAULT_B, "col": "rfm_segment", "extra": ["signup_date"]},
}


def rule_sql(cond: str, r: str = "R_score", f: str = "F_score", m: str = "M_score") -> str:
    """Rule text over r / f / m -> SQL over the score columns."""
    cols = {"r": r, "f": f, "m": m}
    return re.sub(r"\b([rfm])\b", lambda mt: cols[mt.group(1)], cond)


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def segment_expr(rules, default: str, r: str = "R_score", f: str = "F_score", m: str = "M_score") -> Column:
    """CASE over score triples, first match wins; a NULL score falls through to the default."""
    parts = " ".join(f"WHEN {rule_sql(cond, r, f, m)} THEN {_quote(name)}" for name, cond in rules)
    return F.expr(f"CASE {parts} ELSE {_quote(default)} END")


def rfm_metrics(transactions: DataFrame, plus_days: int = 0, reference: DataFrame | None = None) -> DataFrame:
    """Per-customer recency / frequency / monetary over Completed transactions.

    Reference date = latest transaction date over *all* statuses (+ plus_days);
    ``reference`` gives it as a one-row frame when ``transactions`` is the
    customer-month table.  Customers without a Completed transaction are absent.
    """
    ref = reference if reference is not None else reference_date(transactions)
    per = customer_months(transactions).groupBy("customer_id").agg(
        F.max("last_date").alias("_last"), F.sum("transactions").alias("frequency"), F.sum("revenue").cast("double").alias("_m")
    )
    return scalar_join(per, ref.select(F.date_add("reference_date", plus_days).alias("_ref"))).select(
        "customer_id",
        F.datediff(F.col("_ref"), F.col("_last")).alias("recency"),
        "frequency",
        F.greatest(F.col("_m"), F.lit(0.0)).alias("monetary"),
    )


def rfm_scores(metrics: DataFrame, q: int = 5) -> DataFrame:
    """Add R/F/M scores, RFM_score text and RFM_total.

    R: value quantile bins of recency (exact edges, right-closed, 5 = low
    recency).  F, M: rank-first bins via distributed ``global_rank``.
    """
    probs = [k / q for k in range(1, q)]
    # recency is a day count inside the data's calendar span: bounded distinct values
    edges = exact_quantiles_bounded(metrics, "recency", probs, prefix="_re")
    n = metrics.agg(F.count(F.lit(1)).alias("_n"))
    df = global_rank(metrics, ["frequency", "customer_id"], out="_rf")
    df = global_rank(df, ["monetary", "customer_id"], out="_rm")
    df = scalar_join(scalar_join(df, n), edges)
    labels = list(range(q, 0, -1))
    r = qcut_value(F.col("recency"), [F.col(f"_re{i}") for i in range(q - 1)], labels)
    df = df.select(
        *metrics.columns,
        r.cast("int").alias("R_score"),
        qcut_rank(F.col("_rf"), F.col("_n"), q).alias("F_score"),
        qcut_rank(F.col("_rm"), F.col("_n"), q).alias("M_score"),
    )
    return df.withColumn(
        "RFM_score", F.concat(F.col("R_score").cast("string"), F.col("F_score").cast("string"), F.col("M_score").cast("string"))
    ).withColumn("RFM_total", F.col("R_score") + F.col("F_score") + F.col("M_score"))


def rfm_label(scored: DataFrame, customers: DataFrame, variant: str = "B") -> DataFrame:
    """Segment label and customer attributes on variant-A scores.

    Variant B counts recency from one day later; a shift moves all quantile edges
    alike, so the scores are the same and only recency changes.
    """
    v = VARIANTS[variant]
    out = scored.withColumn("recency", F.col("recency") + F.lit(v["plus_days"])).withColumn(v["col"], segment_expr(v["rules"], v["default"]))
    attrs = customers.select("customer_id", "country", "industry", "subscription_type", *v["extra"])
    return out.join(attrs, "customer_id", "left")


def rfm_table(transactions: DataFrame, customers: DataFrame, variant: str = "B") -> DataFrame:
    """D8 + D9: scored RFM table with segment label and customer attributes."""
    return rfm_label(rfm_scores(rfm_metrics(transactions)), customers, variant)


def rfm_metric_summary(rfm: DataFrame) -> DataFrame:
    """Min / max / mean of each RFM metric, one row."""
    return rfm.agg(
        F.min("recency").alias("recency_min"),
        F.max("recency").alias("recency_max"),
        F.avg("recency").alias("recency_mean"),
        F.min("frequency").alias("frequency_min"),
        F.max("frequency").alias("frequency_max"),
        F.avg("frequency").alias("frequency_mean"),
        F.min("monetary").alias("monetary_min"),
        F.max("monetary").alias("monetary_max"),
        safe_div(money_sum("monetary"), F.count("monetary")).alias("monetary_mean"),
    )


def segment_summary(rfm: DataFrame, segment_col: str = "segment") -> DataFrame:
    """D10 (variant A): per-segment count, means and revenue."""
    return (
        rfm.groupBy(F.col(segment_col).alias("segment"))
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.avg("recency").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
            money_sum("monetary").alias("total_revenue"),
            safe_div(money_sum("monetary"), F.count("monetary")).alias("avg_revenue"),
            F.avg("RFM_total").alias("avg_rfm_score"),
        )
        .orderBy(F.desc("avg_rfm_score"), "segment")
    )


def _text_lookup(col: Column, mapping: dict[str, str], default: str) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col], F.lit(default))


def segment_summary_b(rfm: DataFrame) -> DataFrame:
    """D10 (variant B): adds description, action and customer / revenue shares (1 decimal, half-even)."""
    base = segment_summary(rfm, "rfm_segment")
    tot = rfm.agg(F.count(F.lit(1)).alias("_nc"), money_sum("monetary").alias("_rv"))
    return scalar_join(base, tot).select(
        "segment",
        "customer_count",
        "avg_recency",
        "avg_frequency",
        "total_revenue",
        "avg_revenue",
        "avg_rfm_score",
        _text_lookup(F.col("segment"), {k: v[0] for k, v in SEGMENT_TEXT_B.items()}, "N/A").alias("description"),
        _text_lookup(F.col("segment"), {k: v[1] for k, v in SEGMENT_TEXT_B.items()}, "N/A").alias("recommended_action"),
        F.bround(safe_div(F.col("customer_count"), F.col("_nc")) * 100, 1).alias("customer_pct"),
        F.bround(safe_div(F.col("total_revenue"), F.col("_rv")) * 100, 1).alias("revenue_pct"),
    ).orderBy(F.desc("avg_rfm_score"), "segment")


def segment_kpis(summary_b: DataFrame) -> DataFrame:
    """Dashboard-card subset of the variant-B summary."""
    return summary_b.select(
        "segment", "customer_count", "customer_pct", "total_revenue", "revenue_pct", "avg_revenue", "avg_rfm_score"
    )


def money_text(x: Column) -> Column:
    """'$1,234.50' (negative prints '$-1,234.50' as Python's f-string does)."""
    return F.concat(F.lit("$"), F.format_number(x, 2))


def segmentation_dashboard(rfm_b: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Per-customer dashboard rows (RFM, segment, cluster label, money text)."""
    df = rfm_b
    if clusters is not None:
        df = df.join(clusters.select("customer_id", "behavioral_segment"), "customer_id", "left")
    else:
        df = df.withColumn("behavioral_segment", F.lit(None).cast("string"))
    return df.select(
        "customer_id",
        "recency",
        "frequency",
        "monetary",
        "R_score",
        "F_score",
        "M_score",
        "RFM_score",
        "RFM_total",
        "rfm_segment",
        "behavioral_segment",
        "country",
        "industry",
        "subscription_type",
        money_text(F.col("monetary")).alias("revenue_formatted"),
    )


def segment_insights(summary_b: DataFrame) -> DataFrame:
    """Top segment by mean RFM score, largest segment, highest mean revenue (ties by name)."""
    return summary_b.agg(
        F.min_by("segment", F.struct(-F.col("avg_rfm_score"), F.col("segment"))).alias("top_segment"),
        F.min_by("segment", F.struct(-F.col("customer_count"), F.col("segment"))).alias("largest_segment"),
        F.min_by("segment", F.struct(-F.col("avg_revenue"), F.col("segment"))).alias("highest_value_segment"),
    )
