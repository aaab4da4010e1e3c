"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Keys follow SURVEY §2; each has a DuckDB twin in ``tidemark.plans.oracle``
unless it is an ML / iterative operator (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import charts, churn, cluster, cohort, describe, features, lifecycle, profit, retention, rfm, series, trend, unified
from tidemark.plans.context import Tables
from tidemark.session import forget_lost, on_cleanup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_RUNS: dict[tuple, Tables] = {}


_INPUTS = ("customer", "nation", "orders", "lineitem", "events")


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and time of each input, so that changed files are a run of their own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in _INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            status = fs.getFileStatus(path)
            out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)


def tables_for(spark: SparkSession, sf_dir: str, grain: str = "lineitem") -> Tables:
    """One pipeline run per (application, inputs, grain): shared tables are staged once, and again if they are gone."""
    forget_lost(spark)
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, grain, _input_state(spark, sf_dir))
    if key not in _RUNS:
        _RUNS[key] = Tables(spark, sf_dir, grain)
    return _RUNS[key]


@on_cleanup
def _forget(paths: list[str]) -> None:
    """A run whose staged tables are deleted is not used again."""
    for key, run in list(_RUNS.items()):
        if any(run._run in p for p in paths):
            del _RUNS[key]


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Published precision: rounds at the edge, never inside an operator."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


BAND = {"forecast": 2, "lower": 2, "upper": 2}
STD = {"std_transaction": 6}
SLOPES = {"slope_before": 2, "slope_after": 2}
TEST = {"adf_statistic": 6, "critical_value_5pct": 6, "p_value": 6}
ERRORS = {"mae": 4, "rmse": 4, "mape": 4}
ENSEMBLE = {"forecast_seasonal": 2, "forecast_ar": 2, "forecast_ensemble": 2, "cumulative_forecast": 2}


# key -> function of a Tables run (lineitem-grain keys; usable with any inputs)
TABLE_FUNCTIONS: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(tables_for(spark, sf_dir))
        TABLE_FUNCTIONS[name] = fn
        return fn

    return deco


@query("clean_customers")
def _q_clean_customers(t: Tables) -> DataFrame:
    return t.customers


@query("clean_transactions")
def _q_clean_transactions(t: Tables) -> DataFrame:
    return t.transactions


@query("customer_features")
def _q_customer_features(t: Tables) -> DataFrame:
    return rounded(t.customer_features, STD)


@query("transaction_features")
def _q_transaction_features(t: Tables) -> DataFrame:
    return t.transaction_features


@query("daily_revenue")
def _q_daily_revenue(t: Tables) -> DataFrame:
    return features.daily_revenue(t.transactions)


@query("monthly_revenue")
def _q_monthly_revenue(t: Tables) -> DataFrame:
    return features.monthly_revenue(t.transactions)


@query("monthly_revenue_agg")
def _q_monthly_revenue_agg(t: Tables) -> DataFrame:
    return features.monthly_revenue_agg(t.raw_transactions)


@query("monthly_acquisitions")
def _q_monthly_acquisitions(t: Tables) -> DataFrame:
    return features.monthly_acquisitions(t.customers)



@query("rfm_scores")
def _q_rfm_scores(t: Tables) -> DataFrame:
    return t.rfm_scored


@query("rfm_segments_a")
def _q_rfm_segments_a(t: Tables) -> DataFrame:
    return t.rfm_a


@query("rfm_segments_b")
def _q_rfm_segments_b(t: Tables) -> DataFrame:
    return t.rfm_b


@query("rfm_metric_summary")
def _q_rfm_metric_summary(t: Tables) -> DataFrame:
    return rfm.rfm_metric_summary(t.rfm_b)


@query("rfm_summary_a")
def _q_rfm_summary_a(t: Tables) -> DataFrame:
    return rfm.segment_summary(t.rfm_a, "segment")


@query("rfm_summary_b")
def _q_rfm_summary_b(t: Tables) -> DataFrame:
    return t.segment_summary_b


@query("segment_kpis")
def _q_segment_kpis(t: Tables) -> DataFrame:
    return rfm.segment_kpis(t.segment_summary_b)


@query("segment_insights")
def _q_segment_insights(t: Tables) -> DataFrame:
    return rfm.segment_insights(t.segment_summary_b)


@query("cohort_counts")
def _q_cohort_counts(t: Tables) -> DataFrame:
    return t.cohort_counts


@query("cohort_retention")
def _q_cohort_retention(t: Tables) -> DataFrame:
    return t.retention_a


@query("average_retention")
def _q_average_retention(t: Tables) -> DataFrame:
    return cohort.average_retention(t.retention_a)


@query("retention_curve")
def _q_retention_curve(t: Tables) -> DataFrame:
    return t.retention_curve


@query("retention_dashboard")
def _q_retention_dashboard(t: Tables) -> DataFrame:
    return cohort.retention_dashboard(t.retention_b, 12)


@query("cohort_revenue")
def _q_cohort_revenue(t: Tables) -> DataFrame:
    return t.cohort_revenue


@query("cohort_revenue_overall")
def _q_cohort_revenue_overall(t: Tables) -> DataFrame:
    return cohort.cohort_revenue_overall(t.cohort_revenue)


@query("segmentation_metrics")
def _q_segmentation_metrics(t: Tables) -> DataFrame:
    return cohort.segmentation_metrics(t.rfm_b, t.cohorted, t.retention_curve)


@query("lifecycle_stages")
def _q_lifecycle_stages(t: Tables) -> DataFrame:
    return lifecycle.lifecycle_stages(t.customer_features)


@query("lifecycle_summary")
def _q_lifecycle_summary(t: Tables) -> DataFrame:
    return lifecycle.lifecycle_summary(t.customer_features)



@query("verified_revenue")
def _q_verified_revenue(t: Tables) -> DataFrame:
    return profit.verified_revenue(t.customer_features, t.transactions).select(
        "customer_id", "verified_revenue", "total_revenue"
    )


@query("revenue_percentiles")
def _q_revenue_percentiles(t: Tables) -> DataFrame:
    return profit.revenue_percentiles(profit.verified_revenue(t.customer_features, t.transactions))


@query("customer_costs")
def _q_customer_costs(t: Tables) -> DataFrame:
    return t.profit.select("customer_id", "subscription_type", "total_revenue", *profit.COST_COLUMNS, "total_cost")


@query("customer_profit")
def _q_customer_profit(t: Tables) -> DataFrame:
    return rounded(t.profit, STD)


@query("cost_breakdown")
def _q_cost_breakdown(t: Tables) -> DataFrame:
    return profit.cost_breakdown(t.profit)


@query("profit_tier_summary")
def _q_profit_tier_summary(t: Tables) -> DataFrame:
    return profit.profit_tier_summary(t.profit)


@query("contribution_tier")
def _q_contribution_tier(t: Tables) -> DataFrame:
    return profit.contribution(t.profit, "profitability_tier")


@query("contribution_subscription")
def _q_contribution_subscription(t: Tables) -> DataFrame:
    return profit.contribution(t.profit, "subscription_type")


@query("contribution_country")
def _q_contribution_country(t: Tables) -> DataFrame:
    return profit.contribution(t.profit, "country")


@query("contribution_industry")
def _q_contribution_industry(t: Tables) -> DataFrame:
    return profit.contribution(t.profit, "industry")


@query("profit_dashboard")
def _q_profit_dashboard(t: Tables) -> DataFrame:
    return profit.profit_dashboard(t.profit)


@query("profit_kpis")
def _q_profit_kpis(t: Tables) -> DataFrame:
    return profit.profit_kpis(t.profit)


@query("top_profitable")
def _q_top_profitable(t: Tables) -> DataFrame:
    return profit.top_profitable(t.profit)


@query("top_losses")
def _q_top_losses(t: Tables) -> DataFrame:
    return profit.top_losses(t.profit)


@query("tier_costs")
def _q_tier_costs(t: Tables) -> DataFrame:
    return profit.tier_costs(t.profit)



@query("churn_predictions")
def _q_churn_predictions(t: Tables) -> DataFrame:
    return t.churn_predictions


@query("churn_risk_summary")
def _q_churn_risk_summary(t: Tables) -> DataFrame:
    return retention.churn_risk_summary(t.churn_predictions)


@query("high_risk_list")
def _q_high_risk_list(t: Tables) -> DataFrame:
    return retention.high_risk_list(t.churn_predictions, t.customer_features)


@query("value_scores")
def _q_value_scores(t: Tables) -> DataFrame:
    return t.value_scores


@query("retention_recommendations")
def _q_retention_recommendations(t: Tables) -> DataFrame:
    return retention.published_order(t.recommendations)


@query("retention_action_summary")
def _q_retention_action_summary(t: Tables) -> DataFrame:
    return retention.action_summary(t.action_totals)


@query("retention_by_risk_sub")
def _q_retention_by_risk_sub(t: Tables) -> DataFrame:
    return retention.by_risk_subscription(t.action_totals)


@query("retention_impact")
def _q_retention_impact(t: Tables) -> DataFrame:
    return retention.retention_impact(t.action_totals)


@query("retention_top_at_risk")
def _q_retention_top_at_risk(t: Tables) -> DataFrame:
    return retention.top_at_risk(t.recommendations)


@query("retention_list_high")
def _q_retention_list_high(t: Tables) -> DataFrame:
    return retention.published_order(retention.risk_list(t.recommendations, "High"))


@query("retention_list_medium")
def _q_retention_list_medium(t: Tables) -> DataFrame:
    return retention.published_order(retention.risk_list(t.recommendations, "Medium"))


@query("retention_list_low")
def _q_retention_list_low(t: Tables) -> DataFrame:
    return retention.published_order(retention.risk_list(t.recommendations, "Low"))


@query("monthly_series")
def _q_monthly_series(t: Tables) -> DataFrame:
    return t.monthly_series


@query("decomposition")
def _q_decomposition(t: Tables) -> DataFrame:
    return t.decomposition


@query("seasonal_indices")
def _q_seasonal_indices(t: Tables) -> DataFrame:
    return t.seasonal_indices


@query("trend_growth")
def _q_trend_growth(t: Tables) -> DataFrame:
    return series.trend_growth(t.decomposition)


@query("stationarity")
def _q_stationarity(t: Tables) -> DataFrame:
    return rounded(series.stationarity(t.monthly_series), TEST)


@query("forecast_ar")
def _q_forecast_ar(t: Tables) -> DataFrame:
    return rounded(t.forecast_ar, BAND)


@query("forecast_seasonal_trend")
def _q_forecast_seasonal_trend(t: Tables) -> DataFrame:
    return rounded(t.forecast_seasonal, BAND)


@query("forecast_bent_trend")
def _q_forecast_bent_trend(t: Tables) -> DataFrame:
    return rounded(trend.forecast_bent_trend(t.monthly_series, decomposition=t.decomposition), BAND)


@query("trend_change_points")
def _q_trend_change_points(t: Tables) -> DataFrame:
    return rounded(trend.change_points(t.decomposition), SLOPES)


@query("forecast_metrics")
def _q_forecast_metrics(t: Tables) -> DataFrame:
    return rounded(t.forecast_metrics, ERRORS)


@query("model_comparison")
def _q_model_comparison(t: Tables) -> DataFrame:
    return rounded(series.model_comparison(t.forecast_metrics), {"seasonal_trend": 4, "ar": 4})


@query("combined_forecast")
def _q_combined_forecast(t: Tables) -> DataFrame:
    return rounded(t.combined_forecast, ENSEMBLE)


@query("forecast_totals")
def _q_forecast_totals(t: Tables) -> DataFrame:
    return rounded(series.forecast_totals(t.combined_forecast), {"forecasted_revenue_total": 2, "avg_monthly_forecast": 2})


@query("master_customers")
def _q_master_customers(t: Tables) -> DataFrame:
    return t.master


@query("monthly_business_summary")
def _q_monthly_business_summary(t: Tables) -> DataFrame:
    return t.business_summary


@query("fact_customer_metrics")
def _q_fact_customer_metrics(t: Tables) -> DataFrame:
    return unified.fact_customer_metrics(t.master)


@query("dim_customer_attributes")
def _q_dim_customer_attributes(t: Tables) -> DataFrame:
    return unified.dim_customer_attributes(t.master)


@query("dim_retention_actions")
def _q_dim_retention_actions(t: Tables) -> DataFrame:
    return unified.dim_retention_actions(t.master)


@query("fact_monthly_summary")
def _q_fact_monthly_summary(t: Tables) -> DataFrame:
    return t.business_summary


@query("fact_revenue_forecast")
def _q_fact_revenue_forecast(t: Tables) -> DataFrame:
    return rounded(unified.fact_revenue_forecast(t.combined_forecast), ENSEMBLE)


@query("dim_date")
def _q_dim_date(t: Tables) -> DataFrame:
    return unified.dim_date(t.customers, t.transactions)


@query("dim_date_v2")
def _q_dim_date_v2(t: Tables) -> DataFrame:
    return unified.dim_date_v2(t.transactions)


@query("kpi_summary")
def _q_kpi_summary(t: Tables) -> DataFrame:
    return unified.kpi_summary(t.master, t.business_summary, t.combined_forecast)


@query("segment_summary")
def _q_segment_summary(t: Tables) -> DataFrame:
    return unified.segment_summary(t.master)


@query("executive_kpis")
def _q_executive_kpis(t: Tables) -> DataFrame:
    return unified.executive_kpis(t.customer_features, t.transactions, t.profit, retention.churn_risk_summary(t.churn_predictions))


@query("fact_transactions")
def _q_fact_transactions(t: Tables) -> DataFrame:
    return unified.fact_transactions(t.transactions)


@query("dim_customers")
def _q_dim_customers(t: Tables) -> DataFrame:
    return unified.dim_customers(t.customers)


@query("monthly_summary")
def _q_monthly_summary(t: Tables) -> DataFrame:
    return unified.monthly_summary(t.transactions)


@query("customer_metrics")
def _q_customer_metrics(t: Tables) -> DataFrame:
    return unified.customer_metrics(t.customer_features, t.churn_predictions, t.rfm_a)


@query("margin_by_subscription")
def _q_margin_by_subscription(t: Tables) -> DataFrame:
    return unified.margin_by_subscription(t.profit)


@query("top_segments")
def _q_top_segments(t: Tables) -> DataFrame:
    return unified.top_segments(t.rfm_a)


@query("classification_metrics")
def _q_classification_metrics(t: Tables) -> DataFrame:
    return churn.classification_metrics(t.det_scored)


@query("confusion_matrix")
def _q_confusion_matrix(t: Tables) -> DataFrame:
    return churn.confusion_matrix(t.det_scored)


@query("roc_curve")
def _q_roc_curve(t: Tables) -> DataFrame:
    return churn.roc_curve(t.det_scored)


@query("histogram_margin")
def _q_histogram_margin(t: Tables) -> DataFrame:
    return charts.histogram(t.profit, "profit_margin", 40)


@query("histogram_rfm_total")
def _q_histogram_rfm_total(t: Tables) -> DataFrame:
    return charts.histogram(t.rfm_b, "RFM_total", 13)


@query("histogram_churn_probability")
def _q_histogram_churn_probability(t: Tables) -> DataFrame:
    return charts.histogram(t.churn_predictions, "churn_probability", 30)


@query("rf_matrix")
def _q_rf_matrix(t: Tables) -> DataFrame:
    return charts.rf_matrix(t.rfm_b)


@query("cohort_heatmap")
def _q_cohort_heatmap(t: Tables) -> DataFrame:
    return charts.cohort_heatmap(t.retention_a)


@query("revenue_by_country_top8")
def _q_revenue_by_country_top8(t: Tables) -> DataFrame:
    return charts.revenue_by(t.master, 'country', 'total_revenue', 8)


@query("revenue_by_segment")
def _q_revenue_by_segment(t: Tables) -> DataFrame:
    return charts.revenue_by(t.master, 'customer_segment', 'total_revenue')


@query("revenue_by_subscription")
def _q_revenue_by_subscription(t: Tables) -> DataFrame:
    return charts.revenue_by(t.master, 'subscription_type', 'total_revenue')


@query("risk_revenue_by_segment_top6")
def _q_risk_revenue_by_segment_top6(t: Tables) -> DataFrame:
    return charts.revenue_by(t.master.where("churn_risk_level = 'High'"), 'customer_segment', 'total_revenue', 6)


@query("action_counts_top5")
def _q_action_counts_top5(t: Tables) -> DataFrame:
    return charts.action_counts(t.recommendations)


@query("profit_by_tier")
def _q_profit_by_tier(t: Tables) -> DataFrame:
    return charts.profit_by_tier(t.profit)


@query("risk_level_counts")
def _q_risk_level_counts(t: Tables) -> DataFrame:
    return charts.risk_level_counts(t.churn_predictions)


@query("churn_model_comparison")
def _q_churn_model_comparison(t: Tables) -> DataFrame:
    return churn.model_comparison(t.churn_models)


@query("churn_feature_importance")
def _q_churn_feature_importance(t: Tables) -> DataFrame:
    return churn.feature_importance(t.churn_models)


@query("churn_scores_ml")
def _q_churn_scores_ml(t: Tables) -> DataFrame:
    return retention.churn_predictions(t.customer_features, churn.score_customers(t.churn_models.rf, t.customer_features))


@query("behavioral_clusters")
def _q_behavioral_clusters(t: Tables) -> DataFrame:
    return cluster.behavioural_segments(t.clusters[0], t.cluster_profile)


@query("cluster_profile")
def _q_cluster_profile(t: Tables) -> DataFrame:
    return t.cluster_profile


@query("silhouette_scores")
def _q_silhouette_scores(t: Tables) -> DataFrame:
    return t.clusters[1]


@query("segmentation_dashboard")
def _q_segmentation_dashboard(t: Tables) -> DataFrame:
    return rfm.segmentation_dashboard(t.rfm_b, cluster.behavioural_segments(t.clusters[0], t.cluster_profile))




@query("forecast_arma")
def _q_forecast_arma(t: Tables) -> DataFrame:
    return rounded(series.forecast_arma_grid(t.monthly_series)[0], BAND)


@query("arma_order_aic")
def _q_arma_order_aic(t: Tables) -> DataFrame:
    return rounded(series.forecast_arma_grid(t.monthly_series)[1], {"aic": 4})



@query("customer_describe")
def _q_customer_describe(t: Tables) -> DataFrame:
    from tidemark.plans.oracle import DESCRIBE_COLS

    out = describe.describe_exact(t.customer_features, DESCRIBE_COLS)
    return out.withColumn("value", F.when(F.col("stat") == "std", F.round("value", 6)).otherwise(F.col("value")))



@query("cohort_retention_month0")
def _q_cohort_retention_month0(t: Tables) -> DataFrame:
    return cohort.cohort_retention(t.cohort_counts, base="month0")


@query("cohort_retention_size")
def _q_cohort_retention_size(t: Tables) -> DataFrame:
    return cohort.cohort_retention(t.cohort_counts, base="cohort_size", cohort_sizes=cohort.cohort_sizes(t.customers))


@query("cohort_counts_matrix")
def _q_cohort_counts_matrix(t: Tables) -> DataFrame:
    return cohort.to_blocks(t.cohort_counts, "customers")


@query("cohort_counts_wide")
def _q_cohort_counts_wide(t: Tables) -> DataFrame:
    return cohort.to_matrix(t.cohort_counts, "customers")


@query("profit_tiers")
def _q_profit_tiers(t: Tables) -> DataFrame:
    return profit.profit_tiers(t.profit)



@query("monthly_series_by_industry")
def _q_monthly_series_by_industry(t: Tables) -> DataFrame:
    return t.industry_series


@query("decomposition_by_industry")
def _q_decomposition_by_industry(t: Tables) -> DataFrame:
    return series.decompose(t.industry_series, ["industry"])


@query("stationarity_by_industry")
def _q_stationarity_by_industry(t: Tables) -> DataFrame:
    return rounded(series.stationarity(t.industry_series, ["industry"]), TEST)


@query("forecast_ar_by_industry")
def _q_forecast_ar_by_industry(t: Tables) -> DataFrame:
    return rounded(series.forecast_ar(t.industry_series, ["industry"]), BAND)


@query("forecast_seasonal_trend_by_industry")
def _q_forecast_seasonal_trend_by_industry(t: Tables) -> DataFrame:
    return rounded(series.forecast_seasonal_trend(t.industry_series, ["industry"]), BAND)


@query("forecast_bent_trend_by_industry")
def _q_forecast_bent_trend_by_industry(t: Tables) -> DataFrame:
    return rounded(trend.forecast_bent_trend(t.industry_series, ["industry"]), BAND)


@query("trend_change_points_by_industry")
def _q_trend_change_points_by_industry(t: Tables) -> DataFrame:
    return rounded(trend.change_points(series.decompose(t.industry_series, ["industry"]), ["industry"]), SLOPES)


@query("forecast_metrics_by_industry")
def _q_forecast_metrics_by_industry(t: Tables) -> DataFrame:
    return rounded(series.holdout_metrics(t.industry_series, ["industry"]), ERRORS)


@query("forecast_arma_by_industry")
def _q_forecast_arma_by_industry(t: Tables) -> DataFrame:
    return rounded(series.forecast_arma_grid(t.industry_series, ["industry"])[0], BAND)


@query("rule_cluster_profile")
def _q_rule_cluster_profile(t: Tables) -> DataFrame:
    return t.rule_profile


@query("rule_segmentation_dashboard")
def _q_rule_segmentation_dashboard(t: Tables) -> DataFrame:
    return rfm.segmentation_dashboard(t.rfm_b, cluster.behavioural_segments(t.rule_clusters, t.rule_profile))


@query("churn_split_counts")
def _q_churn_split_counts(t: Tables) -> DataFrame:
    return churn.split_counts(churn.stratified_split(churn.feature_table(t.customer_features)))


@query("churn_score_comparison")
def _q_churn_score_comparison(t: Tables) -> DataFrame:
    """M9 on two fixed scores that tie."""
    return churn.compare_scores({"logistic_regression": t.det_scored, "random_forest": t.det_scored})


def _grain_query(name: str, grain: str, fn):
    QUERIES[name] = lambda spark, sf_dir: fn(tables_for(spark, sf_dir, grain))


for _g in ("orders", "events"):
    _grain_query(f"customer_features_{_g}", _g, lambda t: rounded(t.customer_features, STD))
    _grain_query(f"monthly_revenue_{_g}", _g, lambda t: features.monthly_revenue(t.transactions))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features (D2) with RFM scores and segment (D8, D9b); customers without a
    Completed transaction keep NULL scores."""
    t = tables_for(spark, sf_dir)
    seg = t.rfm_b.select("customer_id", "recency", "frequency", "monetary", "R_score", "F_score", "M_score",
                         "RFM_score", "RFM_total", "rfm_segment")
    return t.customer_features.join(seg, "customer_id", "left")
