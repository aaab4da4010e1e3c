"""Unified customer table, monthly business summary, star-schema and KPI exports.

The master table is a chain of left joins on customer_id over customer-level
tables (all keyed the same way, so Spark co-partitions them); month-level
tables are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_label
from tidemark.functions.core import favg, fsum, money, money_sum, pct_change, safe_div, scalar_join, share_pct
from tidemark.functions.ranking import global_rank, qcut_rank

# Customer value tiers (rank quartiles of revenue, low to high).
VALUE_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


def _date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def master_customers(
    customer_features: DataFrame,
    transactions: DataFrame,
    churn: DataFrame | None,
    recommendations: DataFrame | None,
    profit: DataFrame | None,
    rfm_b: DataFrame | None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """One row per customer joining churn, retention, profit and segmentation results.

    Absent inputs fall back to the reference's defaults (probability 0,
    'Unknown' labels, 60 % margin).
    """
    m = customer_features.select(
        "customer_id", "signup_date", "country", "industry", "subscription_type", "monthly_fee",
        "total_revenue", "customer_tenure_days", "is_churned",
    )
    if churn is not None:
        m = m.join(churn.select("customer_id", "churn_probability", "churn_risk_level"), "customer_id", "left")
    else:
        m = m.withColumn("churn_probability", F.lit(0.0)).withColumn("churn_risk_level", F.lit("Unknown"))
    if recommendations is not None:
        m = m.join(
            recommendations.select(
                "customer_id", F.col("primary_action").alias("retention_action"), "urgency",
                "recommended_discount_pct", "specific_recommendation",
            ),
            "customer_id",
            "left",
        )
    else:
        m = m.withColumn("retention_action", F.lit("Not Assigned")).withColumn("urgency", F.lit("Unknown"))
        m = m.withColumn("recommended_discount_pct", F.lit(None).cast("int")).withColumn(
            "specific_recommendation", F.lit(None).cast("string")
        )
    if profit is not None:
        m = m.join(
            profit.select("customer_id", "gross_profit", "profit_margin", "profitability_tier", "total_cost"),
            "customer_id",
            "left",
        )
    else:
        m = (
            m.withColumn("gross_profit", F.col("total_revenue") * 0.6)
            .withColumn("profit_margin", F.lit(60.0))
            .withColumn("profitability_tier", F.lit("Unknown"))
            .withColumn("total_cost", F.lit(None).cast("double"))
        )
    if rfm_b is not None:
        seg = rfm_b.select(
            "customer_id", F.col("rfm_segment").alias("customer_segment"), "R_score", "F_score", "M_score", "RFM_total"
        )
        m = m.join(seg, "customer_id", "left")
    else:
        m = m.withColumn("customer_segment", F.lit("Unknown"))
        for c in ["R_score", "F_score", "M_score", "RFM_total"]:
            m = m.withColumn(c, F.lit(None).cast("int"))
    if clusters is not None:
        m = m.join(clusters.select("customer_id", "behavioral_segment"), "customer_id", "left")
    else:
        m = m.withColumn("behavioral_segment", F.lit("Unknown" if rfm_b is None else None).cast("string"))
    ref = transactions.agg(F.max("transaction_date").alias("_ref"))
    m = scalar_join(m, ref)
    m = (
        m.withColumn("signup_cohort", month_label(F.col("signup_date")))
        .withColumn("signup_year", F.year("signup_date"))
        .withColumn("signup_quarter", F.quarter("signup_date"))
        .withColumn("lifetime_months", F.bround(F.datediff(F.col("_ref"), F.col("signup_date")) / 30, 1))
        .drop("_ref")
    )
    # only the key and the revenue are sorted; the rank comes back on the bucketed key
    ranks = global_rank(customer_features.select("customer_id", "total_revenue"), ["total_revenue", "customer_id"], out="_vr")
    n = customer_features.agg(F.count(F.lit(1)).alias("_n"))
    m = scalar_join(m.join(ranks.select("customer_id", "_vr"), "customer_id", "left"), n)
    tiers = F.array(*[F.lit(t) for t in VALUE_TIERS])
    m = m.withColumn("customer_value_tier", F.element_at(tiers, qcut_rank(F.col("_vr"), F.col("_n"), 4))).drop("_vr", "_n")
    return m.na.fill({"churn_probability": 0.0}).na.fill(
        {
            "churn_risk_level": "Unknown",
            "retention_action": "Not Assigned",
            "profitability_tier": "Unknown",
            "customer_segment": "Unknown",
        }
    )


def monthly_business_summary(transactions: DataFrame, customers: DataFrame, master: DataFrame, profit: DataFrame | None) -> DataFrame:
    """Monthly revenue, MoM change, acquisitions, churn by signup cohort, profit estimate, running totals.

    Without a profit table the two columns of the estimate are left out.
    """
    done = transactions.where(F.col("transaction_status") == "Completed")
    monthly = done.groupBy(month_label(F.col("transaction_date")).alias("month")).agg(
        money_sum("amount").alias("revenue"),
        F.count("transaction_id").alias("transactions"),
        F.countDistinct("customer_id").alias("active_customers"),
    )
    w = Window.orderBy("month")  # bounded: one row per month
    monthly = monthly.withColumn("revenue_mom", pct_change("revenue", w)).withColumn(
        "customer_mom", pct_change("active_customers", w)
    )
    acq = customers.groupBy(month_label(F.col("signup_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    churn = master.groupBy(F.col("signup_cohort").alias("month")).agg(
        F.sum("is_churned").alias("churned_customers"),
        F.bround(safe_div(F.sum("is_churned"), F.count("is_churned")) * 100, 2).alias("churn_rate"),
        favg("churn_probability").alias("avg_churn_prob"),
    )
    margin = profit.agg((favg("profit_margin") / 100).alias("_am")) if profit is not None else None
    risk = master.where(F.col("churn_risk_level") == "High").agg(
        F.count(F.lit(1)).alias("total_high_risk_customers"), money_sum("total_revenue").alias("revenue_at_risk")
    )
    m = monthly.join(acq, "month", "left").join(churn, "month", "left")
    m = scalar_join(m if margin is None else scalar_join(m, margin), risk)
    estimate = [] if margin is None else [(F.col("revenue") * F.col("_am")).alias("estimated_profit"), (F.col("_am") * 100).alias("profit_margin_pct")]
    wc = w.rowsBetween(Window.unboundedPreceding, 0)
    m = m.select(
        "month",
        "revenue",
        "transactions",
        "active_customers",
        "revenue_mom",
        "customer_mom",
        F.coalesce(F.col("new_customers"), F.lit(0)).alias("new_customers"),
        "churned_customers",
        "churn_rate",
        "avg_churn_prob",
        *estimate,
        "total_high_risk_customers",
        "revenue_at_risk",
        F.sum(money("revenue")).over(wc).cast("double").alias("cumulative_revenue"),
        F.sum(F.coalesce(F.col("new_customers"), F.lit(0))).over(wc).alias("cumulative_customers"),
    )
    return m.na.fill(0).na.fill(0.0).orderBy("month")


def fact_customer_metrics(master: DataFrame) -> DataFrame:
    """Customer fact table with an int date key of the signup date."""
    return master.select(
        "customer_id", "signup_date", "total_revenue", "gross_profit", "churn_probability", "customer_tenure_days",
        "lifetime_months", _date_key(F.col("signup_date")).alias("date_key"),
    )


def dim_customer_attributes(master: DataFrame) -> DataFrame:
    """Customer attribute dimension."""
    return master.select(
        "customer_id", "country", "industry", "subscription_type", "customer_segment", "behavioral_segment",
        "profitability_tier", "churn_risk_level", "customer_value_tier", "signup_cohort",
    )


def dim_retention_actions(master: DataFrame) -> DataFrame:
    """Retention action dimension."""
    return master.select(
        "customer_id", "retention_action", "urgency",
        F.col("recommended_discount_pct").alias("recommended_discount"),
        F.col("specific_recommendation").alias("specific_action"),
    )


def fact_revenue_forecast(combined: DataFrame) -> DataFrame:
    """Ensemble forecast with date key."""
    return combined.withColumn("date_key", _date_key(F.col("date"))).withColumn("forecast_type", F.lit("Ensemble"))


def _date_rows(spark_df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    # One bounds row exploded to one row per day: bounded by the calendar span.
    return spark_df.select(F.explode(F.sequence(lo, hi)).alias("date"))


def dim_date(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """D31 v1: daily calendar from the first signup to the last transaction + 12 months."""
    b = customers.agg(F.min("signup_date").alias("_lo")).crossJoin(transactions.agg(F.max("transaction_date").alias("_mx")))
    d = b.select(F.explode(F.sequence("_lo", F.add_months("_mx", 12))).alias("date"), "_mx")
    return d.select(
        _date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        (F.col("date") > F.col("_mx")).cast("int").alias("is_forecast_period"),
    )


def dim_date_v2(transactions: DataFrame) -> DataFrame:
    """D31 v2: daily calendar from the first to the last transaction + 12 months, with weekday names."""
    b = transactions.agg(F.min("transaction_date").alias("_lo"), F.max("transaction_date").alias("_mx"))
    d = b.select(F.explode(F.sequence("_lo", F.add_months("_mx", 12))).alias("date"))
    dow = F.weekday("date")
    return d.select(
        _date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        dow.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        (dow >= 5).cast("int").alias("is_weekend"),
        F.year("date").alias("fiscal_year"),
        F.quarter("date").alias("fiscal_quarter"),
    )


def kpi_category(name: Column) -> Column:
    """First match of revenue/profit -> Financial, customer/churn -> Customer, forecast -> Forecast."""
    n = F.lower(name)
    return (
        F.when(n.contains("revenue") | n.contains("profit"), "Financial")
        .when(n.contains("customer") | n.contains("churn"), "Customer")
        .when(n.contains("forecast"), "Forecast")
        .otherwise("Other")
    )


def _stack(one_row: DataFrame, names: list[str], value: str = "value", key: str = "metric") -> DataFrame:
    body = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)
    return one_row.select(F.expr(f"stack({len(names)}, {body}) AS ({key}, {value})"))


def kpi_summary(master: DataFrame, monthly: DataFrame, combined: DataFrame | None) -> DataFrame:
    """18 KPIs (name, numeric value or text, category).

    Numbers go to ``kpi_value`` (DOUBLE) and the one text KPI (top segment) to
    ``kpi_text``, instead of the reference's mixed-type column.
    """
    a = master.agg(
        money_sum("total_revenue").alias("total_revenue"),
        safe_div(money_sum("total_revenue"), F.count("total_revenue")).alias("avg_revenue_per_customer"),
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("is_churned") == 0).alias("active_customers"),
        F.count_if(F.col("is_churned") == 1).alias("churned_customers"),
        fsum("gross_profit").alias("total_profit"),
        favg("profit_margin").alias("avg_profit_margin"),
        F.count_if(F.col("gross_profit") > 0).alias("profitable_customers"),
        F.count_if(F.col("churn_risk_level") == "High").alias("high_risk_customers"),
        F.coalesce(money_sum(F.when(F.col("churn_risk_level") == "High", F.col("total_revenue"))), F.lit(0.0)).alias(
            "revenue_at_risk"
        ),
        favg("lifetime_months").alias("avg_customer_lifetime_months"),
        safe_div(money_sum("total_revenue"), F.count("total_revenue")).alias("avg_customer_ltv"),
        F.countDistinct("customer_segment").alias("num_segments"),
    ).withColumn("churn_rate", safe_div(F.col("churned_customers"), F.col("total_customers")) * 100)
    mo = monthly.agg(safe_div(money_sum("revenue"), F.count("revenue")).alias("monthly_avg_revenue"))
    one = a.crossJoin(mo)
    names = [
        "total_revenue", "avg_revenue_per_customer", "monthly_avg_revenue", "total_customers", "active_customers",
        "churned_customers", "churn_rate", "total_profit", "avg_profit_margin", "profitable_customers",
        "high_risk_customers", "revenue_at_risk", "avg_customer_lifetime_months", "avg_customer_ltv",
    ]
    if combined is not None:
        one = one.crossJoin(
            combined.agg(
                money_sum("forecast_ensemble").alias("forecasted_revenue_12m"),
                safe_div(money_sum("forecast_ensemble"), F.count("forecast_ensemble")).alias("avg_monthly_forecast"),
            )
        )
        names += ["forecasted_revenue_12m", "avg_monthly_forecast"]
    names += ["num_segments"]
    nums = _stack(one, names, "kpi_value", "kpi_name").withColumn("kpi_text", F.lit(None).cast("string"))
    top = master.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("_c")).agg(
        F.min_by("customer_segment", F.struct(-F.col("_c"), F.col("customer_segment"))).alias("kpi_text")
    )
    top = top.select(F.lit("top_segment").alias("kpi_name"), F.lit(None).cast("double").alias("kpi_value"), "kpi_text")
    out = nums.unionByName(top)
    return out.withColumn("kpi_category", kpi_category(F.col("kpi_name")))


def segment_summary(master: DataFrame) -> DataFrame:
    """Customers, revenue, profit and mean churn probability per RFM segment."""
    return master.groupBy(F.col("customer_segment").alias("segment")).agg(
        F.count("customer_id").alias("customers"),
        money_sum("total_revenue").alias("revenue"),
        fsum("gross_profit").alias("profit"),
        favg("churn_probability").alias("avg_churn_prob"),
    )


def executive_kpis(
    customer_features: DataFrame, transactions: DataFrame, profit: DataFrame | None = None, churn_summary: DataFrame | None = None
) -> DataFrame:
    """The executive KPI rows (metric, value), incl. one row per subscription type.

    Without a profit or a churn table their rows are left out, as the reference does.
    """
    c = customer_features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("is_churned") == 0).alias("active_customers"),
        F.count_if(F.col("is_churned") == 1).alias("churned_customers"),
        (F.avg("is_churned") * 100).alias("churn_rate"),
        F.avg("customer_tenure_days").alias("avg_customer_tenure_days"),
        favg("customer_ltv").alias("avg_customer_ltv"),
    )
    done = transactions.where(F.col("transaction_status") == "Completed")
    t = transactions.agg(F.count(F.lit(1)).alias("total_transactions"))
    d = done.agg(
        money_sum("amount").alias("total_revenue"),
        safe_div(money_sum("amount"), F.count("amount")).alias("avg_transaction_value"),
        F.count(F.lit(1)).alias("successful_transactions"),
    )
    per_c = done.groupBy("customer_id").agg(money_sum("amount").alias("_r")).agg(
        favg("_r").alias("avg_revenue_per_customer")
    )
    per_m = done.groupBy(month_label(F.col("transaction_date"))).agg(money_sum("amount").alias("_r")).agg(
        favg("_r").alias("avg_monthly_revenue")
    )
    one = c.crossJoin(t).crossJoin(d).crossJoin(per_c).crossJoin(per_m)
    one = one.withColumn("transaction_success_rate", safe_div(F.col("successful_transactions"), F.col("total_transactions")) * 100)
    names = [
        "total_customers", "active_customers", "churned_customers", "churn_rate", "total_revenue",
        "avg_revenue_per_customer", "avg_transaction_value", "total_transactions", "successful_transactions",
        "transaction_success_rate", "avg_monthly_revenue", "avg_customer_tenure_days", "avg_customer_ltv",
    ]
    if profit is not None:
        p = profit.agg(
            fsum("gross_profit").alias("total_profit"),
            favg("profit_margin").alias("avg_profit_margin"),
            (F.avg((F.col("profit_margin") > 0).cast("int")) * 100).alias("profitable_customers_pct"),
        )
        one = one.crossJoin(p)
        names += ["total_profit", "avg_profit_margin", "profitable_customers_pct"]
    rows = _stack(one, names)
    subs = customer_features.groupBy("subscription_type").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.concat(F.lit("customers_"), F.lower("subscription_type")).alias("metric"), "value"
    )
    if churn_summary is None:
        return rows.unionByName(subs)
    high = churn_summary.where(F.col("risk_level") == "High")
    risk = high.select(F.lit("high_risk_customers").alias("metric"), F.col("customer_count").cast("double").alias("value")).unionByName(
        high.select(F.lit("revenue_at_risk").alias("metric"), F.col("revenue_at_risk").alias("value"))
    )
    return rows.unionByName(subs).unionByName(risk)


def fact_transactions(transactions: DataFrame) -> DataFrame:
    """Transaction fact table with date key and success flag."""
    return transactions.select(
        "transaction_id", "customer_id", _date_key(F.col("transaction_date")).alias("date_key"), "amount",
        "payment_method", "transaction_status", (F.col("transaction_status") == "Completed").cast("int").alias("is_successful"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """Customer dimension with signup date key."""
    return customers.select(
        "customer_id", "signup_date", "country", "industry", "subscription_type", "monthly_fee",
        _date_key(F.col("signup_date")).alias("signup_date_key"),
    )


def monthly_summary(transactions: DataFrame) -> DataFrame:
    """Completed revenue, transactions and distinct customers per month ('yyyy-MM')."""
    return (
        transactions.where(F.col("transaction_status") == "Completed")
        .groupBy(month_label(F.col("transaction_date")).alias("month"))
        .agg(
            money_sum("amount").alias("revenue"),
            F.count("transaction_id").alias("transactions"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def customer_metrics(customer_features: DataFrame, churn: DataFrame | None = None, rfm_a: DataFrame | None = None) -> DataFrame:
    """Customer metrics with the churn score and RFM (variant A) scores that there are."""
    out = customer_features.select(
        "customer_id", "total_revenue", "total_transactions", "customer_tenure_days", "is_churned", "customer_ltv"
    )
    if churn is not None:
        out = out.join(churn.select("customer_id", "churn_probability", "churn_risk_level"), "customer_id", "left")
    if rfm_a is not None:
        out = out.join(rfm_a.select("customer_id", "R_score", "F_score", "M_score", "segment"), "customer_id", "left")
    return out


def margin_by_subscription(profit: DataFrame) -> DataFrame:
    """Mean profit margin per subscription type."""
    return profit.groupBy("subscription_type").agg(favg("profit_margin").alias("avg_margin"))


def top_segments(rfm_a: DataFrame, k: int = 5) -> DataFrame:
    """The k largest RFM segments (variant A) with their share of customers."""
    n = rfm_a.agg(F.count(F.lit(1)).alias("_n"))
    per = rfm_a.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return (
        scalar_join(per, n)
        .select("segment", "customers", share_pct(F.col("customers"), F.col("_n")).alias("pct"))
        .orderBy(F.desc("customers"), "segment")
        .limit(k)
    )
