"""Churn models with Spark ML (M1-M10) and threshold metrics on any score.

The feature table is one row per customer.  Encoding, scaling and both
classifiers are Spark ML stages fitted once and reused for scoring; the
stratified split and CV folds are deterministic (hash rank within class),
computed with the distributed rank instead of a class-partitioned window
(two classes = two hot groups).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.core import nan_to_zero, safe_div, scalar_join
from tidemark.functions.ranking import global_cumsum, global_rank, range_partitions
from tidemark.operators import forest, logistic
from tidemark.session import stage_parquet

# The reference feature list (11 numeric + 3 encoded categoricals).
NUMERIC_FEATURES = [
    "monthly_fee",
    "total_transactions",
    "total_revenue",
    "avg_transaction",
    "successful_transactions",
    "failed_transactions",
    "customer_tenure_days",
    "days_since_last_transaction",
    "transaction_frequency",
    "payment_failure_rate",
    "avg_monthly_revenue",
]
CATEGORICAL_FEATURES = ["country", "industry", "subscription_type"]
LABEL = "is_churned"
SEED = 42
LR_C_GRID = [0.01, 0.1, 1.0, 10.0]
# The forest's grid, 72 points (depth None: no limit).
RF_GRID = {"depth": [5, 10, 15, None], "leaf": [1, 2, 4], "split": [2, 5, 10], "trees": [100, 200]}


@dataclass
class ChurnModels:
    lr: PipelineModel
    rf: PipelineModel
    feature_names: list[str]
    test: DataFrame


def feature_table(customer_features: DataFrame, exclude_leaky: bool = False) -> DataFrame:
    """M2 input: numeric features with NULL/NaN/inf -> 0, categoricals as text, label.

    The label is ``recency > 60`` and recency is a feature (leakage, as in the
    reference); ``exclude_leaky=True`` drops days_since_last_transaction.
    """
    nums = [c for c in NUMERIC_FEATURES if not (exclude_leaky and c == "days_since_last_transaction")]
    return customer_features.select(
        "customer_id",
        *[nan_to_zero(c).alias(c) for c in nums],
        *[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in CATEGORICAL_FEATURES],
        F.col(LABEL).cast("double").alias("label"),
    )


def stratified_split(df: DataFrame, test_fraction: float = 0.2, folds: int = 5, seed: int = SEED) -> DataFrame:
    """M3: exact per-class split and CV folds from a hash rank inside each class.

    Adds ``is_test`` (the first round(fraction * class size) of each class in
    hash order) and ``fold`` (position mod folds).
    """
    h = df.withColumn("_h", F.xxhash64(F.col("customer_id"), F.lit(seed)))
    ranked = global_rank(h, ["label", "_h", "customer_id"], out="_r")
    starts = ranked.groupBy("label").agg(F.min("_r").alias("_s"), F.count(F.lit(1)).alias("_nc"))  # one row per class
    out = ranked.join(F.broadcast(starts), "label").withColumn("_p", F.col("_r") - F.col("_s"))
    return out.select(
        *df.columns,
        (F.col("_p") < F.round(F.col("_nc") * test_fraction)).alias("is_test"),
        (F.col("_p") % folds).cast("int").alias("fold"),
    )


def split_counts(split: DataFrame) -> DataFrame:
    """M3: rows per class, part and fold of a stratified split."""
    return split.groupBy(F.col("label").cast("int").alias("label"), "is_test", "fold").agg(F.count(F.lit(1)).alias("customers"))


def _prep_stages(nums: list[str]) -> tuple[list, list[str]]:
    idx = [
        StringIndexer(inputCol=c, outputCol=f"{c}_encoded", stringOrderType="alphabetAsc", handleInvalid="keep")
        for c in CATEGORICAL_FEATURES
    ]
    names = nums + [f"{c}_encoded" for c in CATEGORICAL_FEATURES]
    asm = VectorAssembler(inputCols=names, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return [*idx, asm, scaler], names


def train_churn_models(
    customer_features: DataFrame,
    exclude_leaky: bool = False,
    rf_grid: dict | None = None,
    parallelism: int = 4,
) -> ChurnModels:
    """M4-M6: scaler fitted on train only; logistic regression (C grid; all fits together, see
    ``operators.logistic``) and random forest (all points of ``rf_grid``, by default the 72 of
    ``RF_GRID``, read off one forest a fold and leaf size, see ``operators.forest``), both by
    mean ROC AUC over five folds.  ``parallelism`` forests are grown at a time.  A grid of one
    point is fitted without folds, as there is nothing to choose."""
    base = feature_table(customer_features, exclude_leaky)
    split = stratified_split(base).persist(StorageLevel.MEMORY_AND_DISK)
    train = split.where(~F.col("is_test"))
    test = split.where(F.col("is_test"))
    nums = [c for c in base.columns if c in NUMERIC_FEATURES]
    stages, names = _prep_stages(nums)
    prep = Pipeline(stages=stages).fit(train)
    spark = base.sparkSession
    # encoded and scaled once; every fit reads this table, with all cores
    parts = max(spark.sparkContext.defaultParallelism, range_partitions(customer_features))
    train_x = stage_parquet(prep.transform(train).select("customer_id", "label", "fold", "features").repartition(parts, "customer_id"), "churn-train")
    best, _ = logistic.cross_validate(train_x, LR_C_GRID, folds=5)
    lr_best = _logistic_model(spark, best.weights)

    grid = rf_grid or RF_GRID
    points = forest.grid_points(grid)
    point = points[0] if len(points) == 1 else forest.cross_validate(train_x, grid, 5, SEED, parallelism)[0]
    rf_best = forest.cut(spark, forest.grow(train_x, max(grid["trees"]), point.leaf, SEED), point)
    split.unpersist()
    return ChurnModels(
        lr=PipelineModel(stages=[*prep.stages, lr_best]),
        rf=PipelineModel(stages=[*prep.stages, rf_best]),
        feature_names=names,
        test=test,
    )


def _logistic_model(spark: SparkSession, weights: np.ndarray) -> LogisticRegressionModel:
    """A Spark ML model with the given weights (the intercept first), so that it scores, saves and loads like any other."""
    sc = spark.sparkContext
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel("tidemark_ridge", _py2java(sc, DenseVector(weights[1:])), float(weights[0]))
    return LogisticRegressionModel(made).setFeaturesCol("features")


def probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("churn_probability", vector_to_array(F.col("probability"))[1])


def score_customers(model: PipelineModel, customer_features: DataFrame, exclude_leaky: bool = False) -> DataFrame:
    """Churn probability for every customer (customer_id, churn_probability)."""
    scored = probability(model.transform(feature_table(customer_features, exclude_leaky)))
    return scored.select("customer_id", "churn_probability")


def classification_metrics(scored: DataFrame, label: str = "label", score: str = "churn_probability", threshold: float = 0.5) -> DataFrame:
    """M7: accuracy, precision, recall, F1 at a threshold + ROC AUC (rank statistic), one row.

    AUC = (sum of positive ranks - P(P+1)/2) / (P N) with average ranks for
    ties; computed with a group-by on the score, so no single-task sort.
    """
    y = F.col(label).cast("int")
    pred = (F.col(score) >= threshold).cast("int")
    c = scored.agg(
        F.count_if((pred == 1) & (y == 1)).alias("tp"),
        F.count_if((pred == 1) & (y == 0)).alias("fp"),
        F.count_if((pred == 0) & (y == 0)).alias("tn"),
        F.count_if((pred == 0) & (y == 1)).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(x) for x in ["tp", "fp", "tn", "fn"])
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, tp + fn)
    m = c.select(
        safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        F.coalesce(prec, F.lit(0.0)).alias("precision"),
        F.coalesce(rec, F.lit(0.0)).alias("recall"),
        F.coalesce(safe_div(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"),
    )
    return m.crossJoin(roc_auc(scored, label, score))


def _score_groups(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score with positive / negative counts (bounded by distinct scores)."""
    y = F.col(label).cast("int")
    return scored.groupBy(F.col(score).alias("s")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "churn_probability") -> DataFrame:
    g = _score_groups(scored, label, score).withColumn("_k", F.col("pos") + F.col("neg"))
    g = global_cumsum(g, ["s"], ["_k"]).withColumn("_below", F.col("_k_cum") - F.col("_k"))
    avg_rank = F.col("_below") + (F.col("_k") + 1) / 2.0
    tot = g.agg(
        F.sum(F.col("pos") * avg_rank).alias("_sr"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")
    )
    return tot.select(
        safe_div(F.col("_sr") - F.col("_p") * (F.col("_p") + 1) / 2.0, F.col("_p") * F.col("_n")).alias("roc_auc")
    )


def confusion_matrix(scored: DataFrame, label: str = "label", score: str = "churn_probability", threshold: float = 0.5) -> DataFrame:
    """M7: counts per (actual, predicted)."""
    return scored.groupBy(
        F.col(label).cast("int").alias("actual"), (F.col(score) >= threshold).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "churn_probability") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending thresholds, from (0, 0) at infinity."""
    g = _score_groups(scored, label, score)
    tot = g.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    # one row per distinct score: running sums with the distributed prefix-sum
    g = global_cumsum(g, [F.col("s").desc()], ["pos", "neg"])
    g = g.withColumnRenamed("pos_cum", "_tp").withColumnRenamed("neg_cum", "_fp")
    points = scalar_join(g, tot).select(
        F.col("s").alias("threshold"),
        safe_div(F.col("_fp"), F.col("_N")).alias("fpr"),
        safe_div(F.col("_tp"), F.col("_P")).alias("tpr"),
    )
    start = tot.select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def feature_importance(models: ChurnModels) -> DataFrame:
    """M8: |coefficient| of the logistic model and impurity importance of the forest, per feature."""
    spark = models.test.sparkSession
    coefs = models.lr.stages[-1].coefficients.toArray().tolist()
    imps = models.rf.stages[-1].featureImportances.toArray().tolist()
    rows = [(n, float(c), abs(float(c)), float(i)) for n, c, i in zip(models.feature_names, coefs, imps)]
    # bounded: one row per model feature
    return spark.createDataFrame(rows, "feature string, lr_coefficient double, lr_abs_coefficient double, rf_importance double")


def model_comparison(models: ChurnModels) -> DataFrame:
    """M9: test-set metrics for both models; best by ROC AUC, a tie goes to logistic regression."""
    return compare_scores({n: probability(m.transform(models.test)) for n, m in (("logistic_regression", models.lr), ("random_forest", models.rf))})


def compare_scores(scored: dict[str, DataFrame]) -> DataFrame:
    """M9 on scored frames (label, churn_probability) by model name."""
    out = None
    for name, frame in scored.items():
        m = classification_metrics(frame).withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    best = out.agg(
        F.min_by("model", F.struct(-F.col("roc_auc"), F.when(F.col("model") == "logistic_regression", 0).otherwise(1))).alias("best_model")
    )
    return out.crossJoin(best)


def save_models(models: ChurnModels, path: str) -> None:
    """Persist both fitted pipelines (Spark ML format, overwrite)."""
    models.lr.write().overwrite().save(f"{path.rstrip('/')}/logistic_regression")
    models.rf.write().overwrite().save(f"{path.rstrip('/')}/random_forest")


def load_model(path: str, name: str = "random_forest") -> PipelineModel:
    """Load one persisted pipeline for scoring with ``score_customers``."""
    return PipelineModel.load(f"{path.rstrip('/')}/{name}")
