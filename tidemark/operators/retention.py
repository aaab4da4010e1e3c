"""Churn risk levels and retention recommendations.

Scores come from any model (``churn.score_customers``) or the deterministic
``recency_score`` used by the oracle tests.  Everything here is projection,
literal lookups and small group-bys; the per-risk dense rank avoids a window
partitioned by the three risk levels (three hot groups).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import favg, money_sum, safe_div, scalar_join
from tidemark.functions.ranking import cut_right, global_dense_rank

# Risk bins (right-closed) and labels.
RISK_EDGES = [0.0, 0.3, 0.6, 1.0]
RISK_LABELS = ["Low", "Medium", "High"]
RISK_ORDER = {"High": 0, "Medium": 1, "Low": 2}

# Strategy per risk level —
# (primary_action, secondary_action, urgency, timeline, discount_min, discount_max, channel).
STRATEGIES = {
    "High": ("Immediate Retention Call", "Exclusive Discount Offer", "Critical", "Within 24-48 hours", 20, 30, "Phone + Email"),
    "Medium": ("Targeted Engagement Email", "Personalized Product Demo", "High", "Within 1 week", 10, 15, "Email + In-App"),
    "Low": ("Loyalty Rewards Program", "Feature Upgrade Offer", "Normal", "Within 30 days", 5, 10, "Email + Newsletter"),
}

# Four action templates per (risk level, subscription type).
ACTION_TEMPLATES = {
    ("High", "Premium"): [
        "Schedule VIP retention call with account manager",
        "Offer {discount}% discount on annual renewal",
        "Provide complimentary premium support for 3 months",
        "Invite to exclusive executive roundtable event",
    ],
    ("High", "Enterprise"): [
        "Escalate to enterprise success team immediately",
        "Offer {discount}% discount + dedicated support",
        "Schedule executive business review meeting",
        "Provide custom integration support package",
    ],
    ("High", "Professional"): [
        "Initiate proactive outreach call",
        "Offer {discount}% discount on next renewal",
        "Provide free upgrade trial to Enterprise tier",
        "Send personalized value demonstration",
    ],
    ("High", "Basic"): [
        "Send win-back email with special offer",
        "Offer {discount}% discount + free tier upgrade trial",
        "Provide onboarding assistance call",
        "Share success stories from similar customers",
    ],
    ("Medium", "Premium"): [
        "Send personalized engagement email from CSM",
        "Offer early access to new premium features",
        "Invite to product feedback session",
        "Share quarterly ROI report",
    ],
    ("Medium", "Enterprise"): [
        "Schedule quarterly business review",
        "Send targeted feature adoption email",
        "Offer {discount}% loyalty discount",
        "Provide advanced training webinar access",
    ],
    ("Medium", "Professional"): [
        "Send re-engagement email campaign",
        "Offer {discount}% discount on upgrade",
        "Share relevant case studies",
        "Provide product tips and best practices",
    ],
    ("Medium", "Basic"): [
        "Send targeted email with usage tips",
        "Offer limited-time upgrade promotion",
        "Share customer success stories",
        "Invite to educational webinar",
    ],
    ("Low", "Premium"): [
        "Enroll in VIP loyalty rewards program",
        "Offer referral bonus program",
        "Provide beta access to new features",
        "Send quarterly appreciation gift",
    ],
    ("Low", "Enterprise"): [
        "Enroll in enterprise loyalty program",
        "Offer multi-year discount incentive",
        "Provide co-marketing opportunities",
        "Invite to customer advisory board",
    ],
    ("Low", "Professional"): [
        "Enroll in loyalty points program",
        "Offer anniversary discount",
        "Provide certification program access",
        "Send feature highlight newsletter",
    ],
    ("Low", "Basic"): [
        "Enroll in basic rewards program",
        "Offer loyalty discount on upgrade",
        "Send monthly tips newsletter",
        "Provide community forum access",
    ],
}

# Specific-recommendation texts and thresholds.
PAYMENT_ISSUE_TEXT = "Address payment issues - offer alternative payment methods"
REENGAGE_TEXT = "Re-engagement campaign - {days} days inactive"
DEMO_TEXT = "Increase engagement - schedule product demo"

VALUE_WEIGHTS = (0.5, 0.3, 0.2)  # revenue, engagement, tenure


def risk_level(p: Column, include_lowest: bool = True) -> Column:
    """(0, .3] Low, (.3, .6] Medium, (.6, 1] High.

    ``include_lowest=True`` puts P = 0 in Low (the reference leaves it NULL
    and then fails in the recommender); ``False`` reproduces pandas exactly.
    """
    return cut_right(p, RISK_EDGES, RISK_LABELS, include_lowest=include_lowest)


def recency_score(customer_features: DataFrame) -> DataFrame:
    """Deterministic churn probability ``least(1, days inactive / 365)`` (oracle stand-in for a model)."""
    return customer_features.select(
        "customer_id", F.least(F.lit(1.0), F.col("days_since_last_transaction") / 365.0).alias("churn_probability")
    )


def churn_predictions(customer_features: DataFrame, scores: DataFrame) -> DataFrame:
    """M10 output table: attributes + probability + risk level."""
    return customer_features.join(scores, "customer_id", "inner").select(
        "customer_id",
        "country",
        "industry",
        "subscription_type",
        "monthly_fee",
        "total_revenue",
        "customer_tenure_days",
        "is_churned",
        "churn_probability",
        risk_level(F.col("churn_probability")).alias("churn_risk_level"),
    )


def churn_risk_summary(predictions: DataFrame) -> DataFrame:
    """Per risk level count, revenue at risk (all-status revenue), mean probability."""
    return predictions.groupBy(F.col("churn_risk_level").alias("risk_level")).agg(
        F.count("customer_id").alias("customer_count"),
        money_sum("total_revenue").alias("revenue_at_risk"),
        favg("churn_probability").alias("avg_probability"),
    )


BEHAVIOUR = [
    "transaction_frequency",
    "avg_monthly_revenue",
    "days_since_last_transaction",
    "payment_failure_rate",
    "successful_transactions",
    "failed_transactions",
]


def with_behaviour(predictions: DataFrame, customer_features: DataFrame) -> DataFrame:
    """Predictions joined with behaviour columns."""
    return predictions.join(customer_features.select("customer_id", *BEHAVIOUR), "customer_id", "left")


def high_risk_list(predictions: DataFrame, customer_features: DataFrame) -> DataFrame:
    """High-risk customers with behaviour columns, probability descending."""
    return (
        with_behaviour(predictions.where(F.col("churn_risk_level") == "High"), customer_features)
        .select(
            "customer_id",
            "country",
            "industry",
            "subscription_type",
            "monthly_fee",
            "total_revenue",
            "customer_tenure_days",
            "days_since_last_transaction",
            "transaction_frequency",
            "payment_failure_rate",
            "churn_probability",
            "churn_risk_level",
        )
        .orderBy(F.desc("churn_probability"), "customer_id")
    )


def value_scores(data: DataFrame) -> DataFrame:
    """Revenue / engagement / tenure scores (% of max), weighted value, dense rank per risk."""
    mx = data.agg(
        F.max("total_revenue").alias("_mr"),
        F.max("transaction_frequency").alias("_mf"),
        F.max("customer_tenure_days").alias("_mt"),
    )
    wr, we, wt = VALUE_WEIGHTS
    df = (
        scalar_join(data, mx)
        .withColumn("revenue_score", safe_div(F.col("total_revenue"), F.col("_mr")) * 100)
        .withColumn("engagement_score", safe_div(F.col("transaction_frequency"), F.col("_mf")) * 100)
        .withColumn("tenure_score", safe_div(F.col("customer_tenure_days"), F.col("_mt")) * 100)
        .withColumn(
            "value_score",
            F.col("revenue_score") * wr + F.col("engagement_score") * we + F.col("tenure_score") * wt,
        )
        .drop("_mr", "_mf", "_mt")
    )
    return global_dense_rank(df, "value_score", group="churn_risk_level", out="priority_rank").withColumn(
        "priority_rank", F.col("priority_rank").cast("int")
    )


def _by_risk(values: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("churn_risk_level")]


def _template(i: int, discount: Column) -> Column:
    m = F.create_map(*[F.lit(x) for (r, s), t in ACTION_TEMPLATES.items() for x in (f"{r}|{s}", t[i])])
    key = F.concat_ws("|", F.col("churn_risk_level"), F.col("subscription_type"))
    return F.replace(m[key], F.lit("{discount}"), discount.cast("string"))


def recommendations(scored: DataFrame) -> DataFrame:
    """21-column recommendation table (``published_order`` sorts it for publication)."""
    dmin = _by_risk({k: v[4] for k, v in STRATEGIES.items()})
    dmax = _by_risk({k: v[5] for k, v in STRATEGIES.items()})
    discount = (dmin + (dmax - dmin) * (F.col("value_score") / 100)).cast("int")
    df = scored.withColumn("recommended_discount_pct", discount)
    actions = [_template(i, F.col("recommended_discount_pct")) for i in range(4)]
    specific = (
        F.when(F.col("payment_failure_rate") > 0.1, F.lit(PAYMENT_ISSUE_TEXT))
        .when(
            F.col("days_since_last_transaction") > 90,
            F.replace(F.lit(REENGAGE_TEXT), F.lit("{days}"), F.col("days_since_last_transaction").cast("string")),
        )
        .when(F.col("transaction_frequency") < 0.5, F.lit(DEMO_TEXT))
        .otherwise(actions[0])
    )
    return df.select(
        "customer_id",
        "country",
        "industry",
        "subscription_type",
        "monthly_fee",
        "total_revenue",
        "churn_probability",
        "churn_risk_level",
        F.bround(F.col("value_score"), 2).alias("value_score"),
        "priority_rank",
        _by_risk({k: v[2] for k, v in STRATEGIES.items()}).alias("urgency"),
        _by_risk({k: v[3] for k, v in STRATEGIES.items()}).alias("action_timeline"),
        _by_risk({k: v[6] for k, v in STRATEGIES.items()}).alias("contact_channel"),
        _by_risk({k: v[0] for k, v in STRATEGIES.items()}).alias("primary_action"),
        _by_risk({k: v[1] for k, v in STRATEGIES.items()}).alias("secondary_action"),
        specific.alias("specific_recommendation"),
        "recommended_discount_pct",
        *[a.alias(f"action_{i + 1}") for i, a in enumerate(actions)],
    )


def published_order(recs: DataFrame) -> DataFrame:
    """Recommendations (or a risk list) by risk level, then value score, highest first."""
    return recs.orderBy(_by_risk(RISK_ORDER), F.desc("value_score"), "customer_id")


#: Grouping ids of ``action_totals``: by risk and subscription, by risk, and over all.
BY_RISK_SUBSCRIPTION, BY_RISK, OVERALL = 0, 1, 3


def action_totals(recs: DataFrame) -> DataFrame:
    """Counts, revenue and means by risk x subscription, by risk and over all customers, in one pass.

    ``level`` is the grouping id; a missing risk level or subscription is a group of its own.
    """
    risk, sub = F.col("churn_risk_level"), F.col("subscription_type")
    return (
        recs.groupingSets([[risk, sub], [risk], []], risk, sub)
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count("customer_id").alias("customer_count"),
            F.count(F.lit(1)).alias("rows"),
            money_sum("total_revenue").alias("total_revenue"),
            favg("value_score").alias("avg_value_score"),
            F.avg("recommended_discount_pct").alias("avg_recommended_discount"),
        )
        .withColumnRenamed("churn_risk_level", "risk_level")
    )


def action_summary(totals: DataFrame) -> DataFrame:
    """Per risk level count, revenue at risk, mean value score and discount (risk order), from ``action_totals``."""
    return (
        totals.where(F.col("level") == BY_RISK)
        .select("risk_level", "customer_count", F.col("total_revenue").alias("total_revenue_at_risk"), "avg_value_score", "avg_recommended_discount")
        .orderBy(F.create_map(*[F.lit(x) for kv in RISK_ORDER.items() for x in kv])[F.col("risk_level")])
    )


def by_risk_subscription(totals: DataFrame) -> DataFrame:
    """Counts and revenue per (risk level, subscription type), from ``action_totals``."""
    return totals.where(F.col("level") == BY_RISK_SUBSCRIPTION).select("risk_level", "subscription_type", "customer_count", F.col("total_revenue").alias("revenue"))


def risk_list(recs: DataFrame, level: str) -> DataFrame:
    """The High / Medium / Low action lists."""
    return recs.where(F.col("churn_risk_level") == level)


def retention_impact(totals: DataFrame) -> DataFrame:
    """If half of high-risk customers are retained — customers saved, revenue protected; from ``action_totals``."""
    high = totals.where((F.col("level") == BY_RISK) & (F.col("risk_level") == "High"))  # one row, or none
    return high.agg(
        F.floor(F.coalesce(F.sum("rows"), F.lit(0)) / 2).cast("long").alias("customers_saved"),
        (F.coalesce(F.sum("total_revenue"), F.lit(0.0)) / 2).alias("revenue_protected"),
    )


def top_at_risk(recs: DataFrame, k: int = 10) -> DataFrame:
    """Top-k high-risk customers by value score (ties by customer_id)."""
    return (
        recs.where(F.col("churn_risk_level") == "High")
        .orderBy(F.desc("value_score"), "customer_id")
        .limit(k)
        .select("customer_id", "subscription_type", "total_revenue", "churn_probability", "specific_recommendation")
    )
