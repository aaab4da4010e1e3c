"""Operator edge cases on hand-made rows (the reference's traps T1-T7) and rule tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cohort, features, lifecycle, profit, retention, rfm

# whole-number ids: the operators take any type that sorts
CUSTOMER_SCHEMA = "customer_id bigint, signup_date date, country string, industry string, subscription_type string, monthly_fee double"
TRANSACTION_SCHEMA = "transaction_id bigint, customer_id bigint, transaction_date date, amount string, payment_method string, transaction_status string"

D = dt.date


@pytest.fixture(scope="module")
def raw(spark):
    customers = spark.createDataFrame(
        [
            (1, D(2021, 1, 5), "USA", "Tech", "Basic", 50.0),
            (1, D(2021, 1, 5), "USA", "Tech", "Basic", 50.0),  # duplicate id
            (2, D(2021, 2, 1), "UK", "Retail", "Premium", None),  # NULL fee -> median
            (3, D(2021, 3, 1), "UK", "Retail", "Enterprise", 300.0),  # no transactions
            (4, D(2021, 1, 20), "USA", "Media", "Professional", 100.0),  # only Failed
            (5, D(2021, 4, 1), "France", "Media", "Gold", 10.0),  # unknown subscription type
        ],
        CUSTOMER_SCHEMA,
    )
    txns = spark.createDataFrame(
        [
            (10, 1, D(2021, 1, 10), "100.0", "ACH", "Completed"),
            (10, 1, D(2021, 1, 11), "999.0", "ACH", "Completed"),  # duplicate id, later row dropped
            (11, 1, D(2021, 3, 1), "50.5", "ACH", "Completed"),
            (12, 1, D(2021, 3, 2), "-20.0", "ACH", "Refunded"),
            (13, 1, D(2021, 3, 3), "abc", "ACH", "Completed"),  # non-numeric
            (14, 1, D(2021, 3, 4), "NaN", "ACH", "Completed"),  # NaN
            (15, 1, D(2021, 3, 5), None, "ACH", "Completed"),  # NULL
            (16, 2, D(2021, 1, 30), "200.0", "PayPal", "Completed"),  # before signup month
            (17, 2, D(2021, 6, 1), "75.0", "PayPal", "Pending"),
            (18, 4, D(2021, 2, 1), "30.0", "Wire", "Failed"),
            (19, 4, D(2021, 2, 2), "30.0", "Wire", "Unknown"),  # invalid status
            (20, 5, D(2021, 5, 1), "10.0", "ACH", "Completed"),
        ],
        TRANSACTION_SCHEMA,
    )
    return customers, txns


@pytest.fixture(scope="module")
def clean(raw):
    c, t = raw
    return features.clean_customers(c), features.clean_transactions(t)


def test_clean(clean):
    c, t = clean
    assert c.count() == 5
    assert c.where("customer_id = 2").first().monthly_fee == 75.0  # median of 10, 50, 100, 300
    ids = sorted(r.transaction_id for r in t.collect())
    assert ids == [10, 11, 12, 16, 17, 18, 20]
    assert t.where("transaction_id = 10").first().amount == 100.0  # keep-first in date order


def test_customer_features_traps(clean):
    c, t = clean
    f = {r.customer_id: r for r in features.customer_features(c, t).collect()}
    ref = D(2021, 6, 1)
    # total_revenue sums all statuses (Refunded negative included)
    assert f[1].total_revenue == pytest.approx(100.0 + 50.5 - 20.0)
    assert f[1].successful_transactions == 2 and f[1].total_transactions == 3
    # T5: a customer without transactions gets zeros, recency 0 and is_churned 0
    assert f[3].total_transactions == 0 and f[3].days_since_last_transaction == 0 and f[3].is_churned == 0
    assert f[3].customer_tenure_days == (ref - D(2021, 3, 1)).days
    assert f[4].failed_transactions == 1 and f[4].payment_failure_rate == pytest.approx(0.5)
    assert f[1].is_churned == 1  # last txn 2021-03-02, 91 days before 2021-06-01
    assert f[2].std_transaction == pytest.approx(88.388348, abs=1e-6)
    assert f[5].std_transaction == 0.0  # one transaction: NULL -> 0


def test_verified_revenue_is_completed_only(clean):
    c, t = clean
    p = {r.customer_id: r for r in profit.profitability(features.customer_features(c, t), t).collect()}
    assert p[1].total_revenue == pytest.approx(150.5)
    assert p[3].total_revenue == 0.0 and p[3].profit_margin == -100.0
    assert p[5].acquisition_cost is None and p[5].total_cost is None  # unknown tier
    assert p[5].profitability_tier == "High Profit"  # NULL comparisons fall through, as NaN does


# Segments by score: for each r a row of five f blocks, in each the five m scores.
GRIDS = {
    "A": (
        {"C": "Champions", "L": "Loyal Customers", "P": "Potential Loyalists", "N": "New Customers", "O": "Promising",
         "R": "At Risk", "H": "Hibernating", "S": "About to Sleep", "A": "Need Attention"},
        {1: "HHHHH HHHHH RRRRR RRRRR RRRRR", 2: "HHHHH HHHHH RRRRR RRRRR RRRRR", 3: "SSPPP SSPPP AOPPP AOPPP AOPPP",
         4: "NNPPP NNPPP LLLLL LLLCC LLLCC", 5: "NNPPP NNPPP LLLLL LLLCC LLLCC"},
    ),
    "B": (
        {"C": "Champions", "L": "Loyal Customers", "P": "Potential Loyalists", "N": "New Customers", "O": "Promising",
         "A": "Need Attention", "S": "About to Sleep", "R": "At Risk", "H": "Hibernating", "X": "Lost"},
        {1: "HHHHH HHHHH XXRRR XXRRR XXRRR", 2: "SSSSS SSSSS SSSSS XXRRR XXRRR", 3: "XXXXX XOOOO AOOOO AOOLL AOOLL",
         4: "NNNNN NPPPP APPPP APPCC APPCC", 5: "NNNNN NPPPP APPPP APPCC APPCC"},
    ),
}


@pytest.mark.parametrize("variant", ["A", "B"])
def test_segment_rules_give_the_written_table(spark, variant):
    v = rfm.VARIANTS[variant]
    names, grid = GRIDS[variant]
    want = {(r, f, m): names[block[m - 1]] for r, row in grid.items() for f, block in enumerate(row.split(), 1) for m in range(1, 6)}
    df = spark.createDataFrame(list(want), "R_score int, F_score int, M_score int")
    got = {(x.R_score, x.F_score, x.M_score): x.s for x in df.select("*", rfm.segment_expr(v["rules"], v["default"]).alias("s")).collect()}
    assert got == want and len(got) == 125


def test_money_sums_keep_small_fractions_and_large_amounts(spark):
    from tidemark.functions.core import money_sum

    small = spark.range(1000).select(F.lit(0.00004).alias("x"))
    assert small.agg(money_sum("x").alias("s")).first().s == 0.04
    large = spark.createDataFrame([(2e14,), (0.01,)], "x double")
    assert large.agg(money_sum("x").alias("s")).first().s == 200000000000000.01


def test_scores_are_the_same_for_both_variants(clean):
    c, t = clean
    f = features.customer_features(c, t)
    a = {r.customer_id: r for r in rfm.rfm_table(t, f, "A").collect()}
    b = {r.customer_id: r for r in rfm.rfm_table(t, f, "B").collect()}
    assert set(a) == set(b)
    for k in a:
        assert b[k].recency == a[k].recency + 1 and b[k].RFM_score == a[k].RFM_score


def test_customer_months_feed_the_same_results(clean):
    c, t = clean
    f, months = features.customer_features(c, t), features.customer_months(t)
    ref = features.reference_date(t)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(rfm.rfm_metrics(months, reference=ref)) == rows(rfm.rfm_metrics(t))
    assert rows(profit.verified_revenue(f, months)) == rows(profit.verified_revenue(f, t))
    assert features.customer_months(months) is months


def test_optional_inputs_fall_back(clean):
    from tidemark.operators import unified

    c, t = clean
    f = features.customer_features(c, t)
    m = {r.customer_id: r for r in unified.master_customers(f, t, None, None, None, None).collect()}
    assert len(m) == f.count()
    for r in m.values():
        assert (r.churn_probability, r.churn_risk_level, r.retention_action, r.profitability_tier) == (0.0, "Unknown", "Not Assigned", "Unknown")
        assert (r.customer_segment, r.behavioral_segment, r.profit_margin) == ("Unknown", "Unknown", 60.0)
    k = {r.metric for r in unified.executive_kpis(f, t).collect()}
    assert "total_revenue" in k and not k & {"total_profit", "high_risk_customers", "revenue_at_risk"}
    assert unified.customer_metrics(f).columns == ["customer_id", "total_revenue", "total_transactions", "customer_tenure_days", "is_churned", "customer_ltv"]


def test_rfm_scores_ties_and_small_n(clean):
    c, t = clean
    table = rfm.rfm_table(t, features.customer_features(c, t), "B")
    rows = {r.customer_id: r for r in table.collect()}
    assert set(rows) == {1, 2, 5}  # only customers with a Completed transaction
    for r in rows.values():
        assert 1 <= r.R_score <= 5 and 1 <= r.F_score <= 5 and 1 <= r.M_score <= 5
        assert r.RFM_total == r.R_score + r.F_score + r.M_score
        assert r.RFM_score == f"{r.R_score}{r.F_score}{r.M_score}"


def test_lifecycle_rule(spark):
    cases = [(90, 0, "New (0-3 months)"), (91, 45, "Growing (3-6 months)"), (180, 46, "Early Churn Risk"),
             (365, 45, "Established (6-12 months)"), (200, 100, "Declining"), (400, 45, "Mature (12+ months)"),
             (400, 90, "At Risk"), (400, 91, "Churned/Dormant")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "t int, i int")
    got = [r.s for r in df.select(lifecycle.stage_expr(F.col("t"), F.col("i")).alias("s")).collect()]
    assert got == [c[2] for c in cases]


def test_risk_levels(spark):
    df = spark.createDataFrame([(p,) for p in [0.0, 0.3, 0.30001, 0.6, 1.0]], "p double")
    got = [r.l for r in df.select(retention.risk_level(F.col("p")).alias("l")).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High"]


def test_recommendation_discount_and_template(spark):
    # golden 3d: Enterprise / Medium, value score 12.98 -> discount int(10 + 5 * 0.1298) = 10
    row = spark.createDataFrame(
        [(1, "X", "Y", "Enterprise", 1.0, 10.0, 0.41, "Medium", 12.98, 1, 0.0, 10, 5.0)],
        "customer_id long, country string, industry string, subscription_type string, monthly_fee double, "
        "total_revenue double, churn_probability double, churn_risk_level string, value_score double, "
        "priority_rank int, payment_failure_rate double, days_since_last_transaction int, transaction_frequency double",
    )
    r = retention.recommendations(row).first()
    assert r.recommended_discount_pct == 10
    assert r.action_3 == "Offer 10% loyalty discount"
    assert r.specific_recommendation == "Schedule quarterly business review"
    assert r.urgency == "High" and r.contact_channel == "Email + In-App"


def test_cohort_retention_golden_variant_a(spark):
    # FIXTURES 3b: counts of 4 cohorts (first 5 offsets) -> variant A retention
    counts = {
        "2021-01": [3, 15, 14, 17, 14],
        "2021-02": [1, 9, 13, 13, 12],
        "2021-03": [None, 17, 18, 20, 18],
        "2021-04": [1, 13, 13, 8, 13],
    }
    rows = [(c, i - 1, v) for c, vs in counts.items() for i, v in enumerate(vs) if v is not None]
    df = spark.createDataFrame(rows, "cohort string, cohort_index int, customers long")
    got = {(r.cohort, r.cohort_index): r.retention for r in cohort.cohort_retention(df).collect()}
    want = {
        "2021-01": [100.0, 500.0, 466.6666666666667, 566.6666666666667, 466.6666666666667],
        "2021-02": [100.0, 900.0, 1300.0, 1300.0, 1200.0],
        "2021-03": [0.0, 0.0, 0.0, 0.0, 0.0],
        "2021-04": [100.0, 1300.0, 1300.0, 800.0, 1300.0],
    }
    for c, vs in want.items():
        for i, v in enumerate(vs):
            assert got[(c, i - 1)] == pytest.approx(v, rel=1e-15)


def test_cohort_matrix_keeps_every_offset(spark):
    """Offsets far outside on both sides have a cell in the folded and in the wide matrix."""
    rows = [("2020-01", i, 100 + i) for i in (-500, -13, -12, -1, 0, 1, 11, 12, 84, 85, 700)] + [("2020-02", 3, 7)]
    long = spark.createDataFrame(rows, "cohort string, cohort_index int, customers long")
    got = {(r.cohort, r.first_index + k, r[f"m{k}"]) for r in cohort.to_blocks(long, "customers").collect() for k in range(12) if r[f"m{k}"] is not None}
    assert got == set(rows)
    wide = cohort.to_matrix(long, "customers")
    assert {(r.cohort, int(c), r[c]) for r in wide.collect() for c in wide.columns[1:] if r[c] is not None} == set(rows)


def test_action_totals_in_one_pass(spark):
    """Every level of the grouping sets equals its own aggregate; missing levels and an empty table are kept apart from totals."""
    rows = [(1, "High", "Basic", 10.5, 3.0, 10.0), (2, "High", "Basic", 1.25, 5.0, 20.0), (3, "High", None, 2.0, 1.0, 5.0), (4, None, "Basic", 7.0, 2.0, None), (5, "Low", "Premium", 0.0, None, 0.0)]
    schema = "customer_id long, churn_risk_level string, subscription_type string, total_revenue double, value_score double, recommended_discount_pct double"
    recs = spark.createDataFrame(rows, schema)
    totals = retention.action_totals(recs)
    got = {(r.risk_level, r.customer_count, r.total_revenue_at_risk) for r in retention.action_summary(totals).collect()}
    assert got == {("High", 3, 13.75), (None, 1, 7.0), ("Low", 1, 0.0)}
    by = {(r.risk_level, r.subscription_type, r.customer_count, r.revenue) for r in retention.by_risk_subscription(totals).collect()}
    assert by == {("High", "Basic", 2, 11.75), ("High", None, 1, 2.0), (None, "Basic", 1, 7.0), ("Low", "Premium", 1, 0.0)}
    assert tuple(retention.retention_impact(totals).first()) == (1, 6.875)
    assert tuple(retention.retention_impact(retention.action_totals(recs.limit(0))).first()) == (0, 0.0)
    assert totals.where("level = 3").first().total_revenue == 20.75
