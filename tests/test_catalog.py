"""Published tables read back: formats, broken runs, dashboards without each optional table."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.plans import runner
from tidemark.plans.catalog import NOTE, OPTIONAL, REQUIRED, Published, dashboards
from tidemark.plans.context import Tables
from tidemark.plans.registry import TABLE_FUNCTIONS
from tidemark.session import stage_parquet

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
KEYS = [*REQUIRED, *(k for k in OPTIONAL if k != "behavioral_clusters"), "master_customers", "kpi_summary"]


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def run(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    runner.run_all(tables, root, keys=KEYS)
    return root


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_table_comes_back_with_its_types(spark, tmp_path, fmt):
    df = spark.sql(
        "SELECT * FROM VALUES (1L, 'a,b', 0.1D, DATE'2021-02-28', CAST(NULL AS INT), true), "
        "(2L, NULL, 1e-17D, NULL, 3, false) AS t(id, name, x, day, n, ok)"
    )
    out = Published(spark, str(tmp_path))
    out.write(df, "one", fmt)
    back = out.table("one")
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    out.write(df.where("false"), "none", fmt)
    assert out.table("none").dtypes == df.dtypes and out.table("none").count() == 0
    assert out.keys() == ["none", "one"]


def test_tables_of_other_programs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    spark.range(3).write.option("header", True).csv(str(tmp_path / "c"))
    out = Published(spark, str(tmp_path))
    assert out.table("p").dtypes == [("id", "bigint")] and out.table("c").dtypes == [("id", "string")]


def test_a_folder_that_broke_off_is_absent(spark, tmp_path):
    out = Published(spark, str(tmp_path))
    out.write(spark.range(3), "t")
    os.remove(tmp_path / "t" / NOTE)
    os.remove(tmp_path / "t" / "_SUCCESS")
    assert not out.has("t") and out.find("t") is None and out.keys() == [] and Published(spark, str(tmp_path / "no")).keys() == []
    with pytest.raises(FileNotFoundError, match="no finished table"):
        out.table("t")


def test_dashboards_equal_those_of_the_run(spark, tables, run):
    made = dashboards(Published(spark, run))
    assert set(made["fact_revenue_forecast"].columns) >= {"forecast_ensemble", "date_key"}
    assert made["kpi_summary"].count() == TABLE_FUNCTIONS["kpi_summary"](tables).count()
    # the run's master knows the rule clusters, which aren't published
    with_clusters = tables.master.drop("behavioral_segment")
    assert rows(made["master_customers"].drop("behavioral_segment")) == rows(with_clusters)
    assert rows(made["customer_metrics"]) == rows(TABLE_FUNCTIONS["customer_metrics"](tables))
    assert rows(made["executive_kpis"]) == rows(TABLE_FUNCTIONS["executive_kpis"](tables))


FALL_BACK = {
    "churn_predictions": lambda m: (m["churn_probability"] == 0) & (m["churn_risk_level"] == "Unknown"),
    "retention_recommendations": lambda m: (m["retention_action"] == "Not Assigned") & (m["urgency"] == "Unknown"),
    "customer_profit": lambda m: (m["profit_margin"] == 60) & (m["profitability_tier"] == "Unknown"),
    "rfm_segments_b": lambda m: (m["customer_segment"] == "Unknown") & m["R_score"].isNull(),
    "churn_risk_summary": lambda m: F.lit(True),
    "rfm_segments_a": lambda m: F.lit(True),
    "combined_forecast": lambda m: F.lit(True),
}


@pytest.mark.parametrize("absent", sorted(FALL_BACK))
def test_each_optional_table_may_be_absent(spark, run, tmp_path, absent):
    root = tmp_path / "out"
    shutil.copytree(run, root, ignore=lambda d, names: [absent] if d == run else [])
    made = dashboards(Published(spark, str(root)))
    master = made["master_customers"]
    n = Published(spark, run).table("customer_features").count()
    assert master.count() == n == master.where(FALL_BACK[absent](master)).count()
    assert ("fact_revenue_forecast" in made) == (absent != "combined_forecast")
    assert ("estimated_profit" in made["monthly_business_summary"].columns) == (absent != "customer_profit")
    assert ("R_score" in made["customer_metrics"].columns) == (absent != "rfm_segments_a")
    kpis = {r.kpi_name for r in made["kpi_summary"].collect()}
    assert ("forecasted_revenue_12m" in kpis) == (absent != "combined_forecast")
    metrics = {r.metric for r in made["executive_kpis"].collect()}
    assert ("total_profit" in metrics) == (absent != "customer_profit")
    assert ("high_risk_customers" in metrics) == (absent != "churn_risk_summary")


def test_a_required_table_may_not(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="clean_customers"):
        dashboards(Published(spark, str(tmp_path)))


def test_a_broken_run_goes_on(spark, tables, tmp_path):
    out, keys = str(tmp_path / "out"), ["clean_customers", "clean_transactions", "monthly_revenue"]
    broken = dict(TABLE_FUNCTIONS)
    broken["monthly_revenue"] = lambda t: spark.range(1).select(F.raise_error(F.lit("lost")).cast("int").alias("x"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(runner, "TABLE_FUNCTIONS", broken)
        with pytest.raises(Exception, match="lost"):
            runner.run_all(tables, out, keys=keys)
    assert Published(spark, out).keys() == keys[:2]
    again = Tables(spark, SF)
    assert list(runner.run_all(again, out, keys=keys, resume=True)) == ["monthly_revenue"]
    assert all(out in f for f in again.transactions.inputFiles())
    assert rows(Published(spark, out).table("monthly_revenue")) == rows(TABLE_FUNCTIONS["monthly_revenue"](tables))
    assert runner.run_all(Tables(spark, SF), out, keys=keys, resume=True) == {}
    # other inputs or another format: written again
    orders = Tables(spark, SF, "orders")
    assert list(runner.run_all(orders, out, keys=keys[:1], resume=True)) == keys[:1]
    assert list(runner.run_all(Tables(spark, SF), out, fmt="csv", keys=keys[:1], resume=True)) == keys[:1]


def test_dashboards_are_written(spark, run, tmp_path):
    keys = runner.run_dashboards(Published(spark, run), str(tmp_path), "csv")
    assert Published(spark, str(tmp_path)).keys() == sorted(keys)
    back = Published(spark, str(tmp_path)).table("master_customers")
    assert back.dtypes == stage_parquet(dashboards(Published(spark, run))["master_customers"], "t").dtypes
