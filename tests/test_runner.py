"""CSV canonical inputs through the runner: text amounts coerced, tables written."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.plans.context import Tables
from tidemark.plans.runner import run_all
from tidemark.sources.io import read_table
from tidemark.sources.schema import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

CUSTOMERS = """customer_id,signup_date,country,industry,subscription_type,monthly_fee
1,2021-01-05,USA,Tech,Basic,50.0
2,2021-02-01,UK,Retail,Premium,
3,2021-03-01,UK,Retail,Enterprise,300.0
"""
TRANSACTIONS = """transaction_id,customer_id,transaction_date,amount,payment_method,transaction_status
10,1,2021-01-10,100.0,ACH,Completed
11,1,2021-03-01,abc,ACH,Completed
12,2,2021-02-10,200.5,PayPal,Completed
13,2,2021-04-01,-20,PayPal,Refunded
14,3,2021-04-02,30,Wire,Failed
"""


def test_csv_inputs_through_runner(spark):
    root = tempfile.mkdtemp(prefix="tidemark-runner-")
    c, t = os.path.join(root, "customers.csv"), os.path.join(root, "transactions.csv")
    open(c, "w").write(CUSTOMERS)
    open(t, "w").write(TRANSACTIONS)
    tables = Tables(spark, raw=(read_table(spark, c, CUSTOMER_SCHEMA), read_table(spark, t, TRANSACTION_SCHEMA)))
    out = os.path.join(root, "out")
    times = run_all(tables, out, keys=["clean_transactions", "customer_features", "monthly_revenue", "profit_kpis"])
    assert set(times) == {"clean_transactions", "customer_features", "monthly_revenue", "profit_kpis"}
    txns = spark.read.parquet(os.path.join(out, "clean_transactions"))
    assert sorted(r.transaction_id for r in txns.collect()) == ["10", "12", "13", "14"]  # 'abc' dropped
    feats = {r.customer_id: r for r in spark.read.parquet(os.path.join(out, "customer_features")).collect()}
    assert feats["2"].monthly_fee == 175.0  # median of 50 and 300
    assert feats["2"].total_revenue == 180.5


def test_cleanup_removes_staged_tables(spark):
    from tidemark.session import _STAGED, cleanup_staged, stage_parquet

    df = stage_parquet(spark.range(5), "cleanup-test")
    assert df.count() == 5
    paths = [p for p in _STAGED[spark.sparkContext.applicationId] if "tidemark-cleanup-test" in p]
    assert cleanup_staged(spark, "cleanup-test") == len(paths) == 1
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)


def test_bucketed_staging_falls_back_without_a_catalog(spark, monkeypatch):
    from tidemark import session

    monkeypatch.setattr(session, "_has_catalog", lambda spark, root: False)
    df = session.stage_bucketed(spark.range(7).withColumnRenamed("id", "customer_id"), "fallback-test", "customer_id", 2)
    assert sorted(r.customer_id for r in df.collect()) == list(range(7))


def test_an_error_of_the_job_is_raised(spark):
    from tidemark.session import stage_bucketed

    bad = spark.range(4).select(F.col("id").alias("customer_id"), F.raise_error(F.lit("broken row")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        stage_bucketed(bad, "broken", "customer_id", 2)


def test_one_file_a_bucket(spark):
    from tidemark.functions.ranking import files_size
    from tidemark.session import stage_bucketed

    df = stage_bucketed(spark.range(0, 10_000, 1, 16).withColumnRenamed("id", "customer_id"), "files", "customer_id", 4)
    assert len(df.inputFiles()) == 4
    assert files_size(df) == sum(os.path.getsize(f.replace("file:", "").replace("///", "/")) for f in df.inputFiles())


def test_partitions_follow_the_files(spark):
    from tidemark.functions.ranking import files_size, range_partitions
    from tidemark.session import stage_parquet

    df = stage_parquet(spark.range(200_000).withColumn("x", F.rand(1)), "sized")
    joined = df.join(df.withColumnRenamed("x", "y"), "id")  # an estimate would multiply the sides
    size = files_size(df)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        assert range_partitions(df) == -(-size // 16384) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert range_partitions(joined) == range_partitions(df)
        assert range_partitions(df, 3) == 3
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


TEXT_CUSTOMERS = """industry,customer_id,signup_date,extra,country,subscription_type,monthly_fee
Tech,CUST_000001,2021-01-05,x,USA,Basic,50.0
Retail,CUST_000002,2021-02-01,x,UK,Premium,
Retail,CUST_000003,not a date,x,UK,Enterprise,300.0
"""


def _write(root, name, text):
    path = os.path.join(root, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_text_ids_and_reordered_columns(spark, tmp_path):
    c = read_table(spark, _write(tmp_path, "customers.csv", TEXT_CUSTOMERS), CUSTOMER_SCHEMA)
    assert c.columns == [f.name for f in CUSTOMER_SCHEMA.fields]
    rows = sorted(c.collect())
    assert [r.customer_id for r in rows] == ["CUST_000001", "CUST_000002", "CUST_000003"]
    assert [r.industry for r in rows] == ["Tech", "Retail", "Retail"]
    assert str(rows[0].signup_date) == "2021-01-05" and rows[2].signup_date is None and rows[1].monthly_fee is None
    txns = "transaction_id,customer_id,transaction_date,amount,payment_method,transaction_status\nTXN_00000001,CUST_000001,2021-02-01,10,ACH,Completed\n"
    tables = Tables(spark, raw=(c, read_table(spark, _write(tmp_path, "t.csv", txns), TRANSACTION_SCHEMA)))
    feats = {r.customer_id: r for r in tables.customer_features.collect()}
    assert len(feats) == 3 and feats["CUST_000001"].total_revenue == 10.0
    assert tables.master.count() == 3


def test_missing_columns_and_lost_keys_are_errors(spark, tmp_path):
    from pyspark.sql import types as T

    from tidemark.sources.schema import require_columns  # noqa: F401

    with pytest.raises(ValueError, match="monthly_fee"):
        read_table(spark, _write(tmp_path, "c.csv", "customer_id,signup_date,country,industry,subscription_type\n1,2021-01-05,a,b,c\n"), CUSTOMER_SCHEMA)
    spark.range(2).write.parquet(f"{tmp_path}/c.parquet")
    with pytest.raises(ValueError, match="customer_id"):
        read_table(spark, f"{tmp_path}/c.parquet", CUSTOMER_SCHEMA)
    keyed = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.LongType(), True)])
    path = _write(tmp_path, "k.csv", "k,v\n1,x\nabc,2\n")
    with pytest.raises(Exception, match="k: not a bigint: abc"):
        read_table(spark, path, keyed).collect()


def test_published_lists_are_in_order(spark, tmp_path):
    tables = Tables(spark, "/root/testdata/sf0.001")
    keys = ["retention_recommendations", "retention_list_high", "retention_list_low"]
    run_all(tables, str(tmp_path), keys=keys)
    rank = {"High": 0, "Medium": 1, "Low": 2}
    for k in keys:
        files = sorted(f for f in os.listdir(f"{tmp_path}/{k}") if f.startswith("part-"))
        rows = [r for f in files for r in spark.read.parquet(f"{tmp_path}/{k}/{f}").collect()]
        order = [(rank[r.churn_risk_level], -r.value_score, r.customer_id) for r in rows]
        assert len(rows) > 5 and order == sorted(order)


def test_queries_work_after_cleanup(spark):
    from tidemark.plans import registry
    from tidemark.session import cleanup_staged

    sf = "/root/testdata/sf0.001"
    n = registry.QUERIES["customer_features"](spark, sf).count()
    run = registry.tables_for(spark, sf)
    assert registry.tables_for(spark, sf) is run
    cleanup_staged(spark, run._run)
    assert registry.tables_for(spark, sf) is not run
    assert registry.QUERIES["customer_features"](spark, sf).count() == n


def test_file_checkpoints_are_refused_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import ensure_checkpoint_dir

    def cluster(**conf):
        sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))

    with pytest.raises(RuntimeError, match="one machine"):
        ensure_checkpoint_dir(cluster(**{"spark.checkpoint.dir": "file:///tmp/x"}))
    mounted = {"spark.checkpoint.dir": "file:///mnt/x", "spark.tidemark.sharedFileSystem": "true"}
    assert ensure_checkpoint_dir(cluster(**mounted)) == "file:///mnt/x"
    assert ensure_checkpoint_dir(cluster(**{"spark.checkpoint.dir": "hdfs://n/x"})) == "hdfs://n/x"
    with pytest.raises(RuntimeError, match="not set"):
        ensure_checkpoint_dir(cluster())
