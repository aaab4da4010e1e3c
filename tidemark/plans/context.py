"""Intermediate tables for one input directory, composed on first use.

An attribute is built when it is first read.  The tables that several modules
read are staged then: a job runs and writes them, and so do the distributed
ranks under some of them.  All other attributes are lazy DataFrames.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ranking import range_partitions
from tidemark.session import stage_bucketed, stage_parquet

from tidemark.operators import churn, cluster, cohort, features, profit, retention, rfm, series, unified
from tidemark.sources.adapters import load_canonical


class Tables:
    """Intermediate tables of one pipeline run.

    With ``materialize=True`` the tables every module reads (cleaned
    customers and transactions, customer features, the monthly series) are
    written once as parquet under the session's checkpoint folder and read
    back, as the reference hands processed tables between modules.  This cuts
    lineage, gives downstream queries column pruning and filter pushdown, and
    survives executor loss (the files are on shared storage).
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        grain: str = "lineitem",
        materialize: bool = True,
        raw: tuple[DataFrame, DataFrame] | None = None,
        fitted_clusters: bool = False,
    ):
        """Inputs are either the driver tables under ``sf_dir`` (through an adapter
        ``grain``) or canonical ``raw = (customers, transactions)`` frames.

        The master table's behavioural label comes from the fixed rules unless
        ``fitted_clusters`` asks for the k-means clusters."""
        self.fitted_clusters = fitted_clusters
        if sf_dir is None and raw is None:
            raise ValueError("give sf_dir or raw=(customers, transactions)")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/") if sf_dir else None
        self.grain = grain
        self.materialize = materialize
        self._given = raw
        self._run = uuid.uuid4().hex[:12]

    def reuse(self, published, keys: set[str]) -> None:
        """Take the cleaned tables among ``keys`` from the published ones of an earlier run on the same inputs."""
        for key, name in (("clean_customers", "customers"), ("clean_transactions", "transactions")):
            if key in keys:
                self.__dict__[name] = published.table(key)

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage_parquet(df, f"{self._run}-{name}") if self.materialize else df

    @cached_property
    def buckets(self) -> int:
        """One bucket count for every customer-level table of the run (so they join
        without shuffles): one for each advisory size of the customer input's files."""
        return range_partitions(self.raw_customers)

    def _stage_customers(self, df: DataFrame, name: str) -> DataFrame:
        """Stage a customer-level table bucketed by customer_id."""
        if not self.materialize:
            return df
        return stage_bucketed(df, f"{self._run}_{name}", "customer_id", self.buckets)

    @cached_property
    def _raw(self) -> tuple[DataFrame, DataFrame]:
        return self._given if self._given is not None else load_canonical(self.spark, self.sf_dir, self.grain)

    @property
    def raw_customers(self) -> DataFrame:
        return self._raw[0]

    @property
    def raw_transactions(self) -> DataFrame:
        return self._raw[1]

    @cached_property
    def customers(self) -> DataFrame:
        first = self._stage(features.dedup_customers(self.raw_customers), "customers_dedup")
        return self._stage_customers(features.impute_monthly_fee(first), "customers")

    @cached_property
    def transactions(self) -> DataFrame:
        return self._stage(features.clean_transactions(self.raw_transactions), "transactions")

    @cached_property
    def customer_features(self) -> DataFrame:
        return self._stage_customers(features.customer_features(self.customers, self.transactions), "customer_features")

    @cached_property
    def transaction_features(self) -> DataFrame:
        return features.transaction_features(self.transactions)

    @cached_property
    def reference(self) -> DataFrame:
        """One row: the latest transaction date over all statuses."""
        return self._stage(features.reference_date(self.transactions), "reference")

    @cached_property
    def customer_months(self) -> DataFrame:
        """Completed activity by customer and month: the fact's one shuffle by customer, shared by RFM,
        cohorts, verified revenue and the keyed series."""
        return self._stage_customers(features.customer_months(self.transactions), "customer_months")

    @cached_property
    def rfm_scored(self) -> DataFrame:
        """Scores are the same for both variants, so they are ranked once."""
        return self._stage_customers(rfm.rfm_scores(rfm.rfm_metrics(self.customer_months, reference=self.reference)), "rfm_scored")

    @cached_property
    def rfm_a(self) -> DataFrame:
        return rfm.rfm_label(self.rfm_scored, self.customer_features, "A")

    @cached_property
    def rfm_b(self) -> DataFrame:
        return rfm.rfm_label(self.rfm_scored, self.customer_features, "B")

    @cached_property
    def segment_summary_b(self) -> DataFrame:
        return rfm.segment_summary_b(self.rfm_b)

    @cached_property
    def cohorted(self) -> DataFrame:
        return self._stage_customers(cohort.with_cohort(self.customer_months, self.customers), "cohorted")

    @cached_property
    def cohort_counts(self) -> DataFrame:
        return self._stage(cohort.cohort_counts(self.cohorted), "cohort_counts")

    @cached_property
    def retention_a(self) -> DataFrame:
        return cohort.cohort_retention(self.cohort_counts, base="first_index", fill_zero=True)

    @cached_property
    def retention_b(self) -> DataFrame:
        return cohort.cohort_retention(self.cohort_counts, base="first_index", fill_zero=False)

    @cached_property
    def retention_curve(self) -> DataFrame:
        return cohort.average_retention(self.retention_b)

    @cached_property
    def cohort_revenue(self) -> DataFrame:
        return cohort.cohort_revenue(self.cohorted)

    @cached_property
    def profit(self) -> DataFrame:
        return self._stage_customers(profit.profitability(self.customer_features, self.customer_months), "profit")

    @cached_property
    def churn_scores(self) -> DataFrame:
        """Deterministic stand-in score (oracle-checkable); the ML score is ``churn.score_customers``."""
        return retention.recency_score(self.customer_features)

    @cached_property
    def churn_predictions(self) -> DataFrame:
        return retention.churn_predictions(self.customer_features, self.churn_scores)

    @cached_property
    def value_scores(self) -> DataFrame:
        return retention.value_scores(retention.with_behaviour(self.churn_predictions, self.customer_features))

    @cached_property
    def recommendations(self) -> DataFrame:
        return self._stage_customers(retention.recommendations(self.value_scores), "recommendations")

    @cached_property
    def action_totals(self) -> DataFrame:
        """Every level of the action summaries, from one pass over the recommendations."""
        return self._stage(retention.action_totals(self.recommendations), "action_totals")

    @cached_property
    def monthly_series(self) -> DataFrame:
        return self._stage(series.monthly_series(self.transactions), "monthly_series")

    @cached_property
    def decomposition(self) -> DataFrame:
        return self._stage(series.decompose(self.monthly_series), "decomposition")

    @cached_property
    def forecast_seasonal(self) -> DataFrame:
        return series.forecast_seasonal_trend(self.monthly_series, decomposition=self.decomposition)

    @cached_property
    def forecast_ar(self) -> DataFrame:
        return series.forecast_ar(self.monthly_series)

    @cached_property
    def forecast_metrics(self) -> DataFrame:
        return self._stage(series.holdout_metrics(self.monthly_series), "forecast_metrics")

    @cached_property
    def combined_forecast(self) -> DataFrame:
        return self._stage(series.combined_forecast(self.forecast_seasonal, self.forecast_ar), "combined_forecast")

    @cached_property
    def master(self) -> DataFrame:
        return self._stage_customers(
            unified.master_customers(
                self.customer_features, self.transactions, self.churn_predictions, self.recommendations, self.profit,
                self.rfm_b, self.behavioural,
            ),
            "master",
        )

    @cached_property
    def business_summary(self) -> DataFrame:
        return self._stage(unified.monthly_business_summary(self.transactions, self.customers, self.master, self.profit), "business_summary")

    @cached_property
    def det_scored(self) -> DataFrame:
        """Deterministic score with the churn label, for oracle-checked threshold metrics."""
        return self.churn_predictions.select(
            "customer_id", F.col("is_churned").cast("double").alias("label"), "churn_probability"
        )

    @cached_property
    def churn_models(self) -> "churn.ChurnModels":
        return churn.train_churn_models(self.customer_features)

    @cached_property
    def clusters(self) -> tuple[DataFrame, DataFrame]:
        c, sil = cluster.kmeans_clusters(self.rfm_b)
        return self._stage_customers(c, "clusters"), sil

    @cached_property
    def cluster_profile(self) -> DataFrame:
        return cluster.cluster_profile(self.rfm_b, self.clusters[0])

    @cached_property
    def rule_clusters(self) -> DataFrame:
        return cluster.rule_clusters(self.rfm_b)

    @cached_property
    def rule_profile(self) -> DataFrame:
        return cluster.cluster_profile(self.rfm_b, self.rule_clusters)

    @cached_property
    def behavioural(self) -> DataFrame:
        """(customer_id, cluster, behavioral_segment) for the master table."""
        if self.fitted_clusters:
            return cluster.behavioural_segments(self.clusters[0], self.cluster_profile)
        return cluster.behavioural_segments(self.rule_clusters, self.rule_profile)

    @cached_property
    def industry_series(self) -> DataFrame:
        return self._stage(series.monthly_series_by(self.customer_months, self.customers, "industry"), "industry_series")

    @cached_property
    def seasonal_indices(self) -> DataFrame:
        return series.seasonal_indices(self.decomposition)
