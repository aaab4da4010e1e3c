"""The published tables of a run, read back (S2, S4, S5), and the dashboards that can be made of them.

A table is a folder ``<root>/<key>`` as ``run_all`` writes it.  It is there once it is
finished: beside its rows lies ``_table.json`` with its schema, its format and the inputs it
was made from, written after them, or Spark's ``_SUCCESS`` where another program wrote it.  A
folder with neither is a table whose writing broke off, and counts as absent.  All tests go
through the Hadoop file system, so the folder may lie on any store that Spark reads.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.functions.ranking import files_size
from tidemark.operators import unified
from tidemark.session import stage_parquet
from tidemark.sources.io import read_table, write_table

NOTE = "_table.json"

#: The tables every dashboard needs, and those it does without.
REQUIRED = ("clean_customers", "clean_transactions", "customer_features")
OPTIONAL = (
    "churn_predictions", "churn_risk_summary", "retention_recommendations", "customer_profit",
    "rfm_segments_a", "rfm_segments_b", "behavioral_clusters", "combined_forecast",
)


def input_mark(*inputs: DataFrame) -> str:
    """One short text for the files behind ``inputs``: their names and their size."""
    digest = hashlib.sha256()
    for df in inputs:
        for name in sorted(df.inputFiles()):
            digest.update(name.encode() + b"\n")
        digest.update(str(files_size(df)).encode() + b"\n")
    return digest.hexdigest()


class Published:
    """The tables under one folder.

    ``find`` gives a table or None, ``table`` raises ``FileNotFoundError``.  With a note the
    columns have the types they were written with, CSV or not; CSV without one is text.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def note(self, key: str) -> dict | None:
        path, fs = self._path(key, NOTE)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def has(self, key: str) -> bool:
        return any(fs.exists(path) for path, fs in (self._path(key, NOTE), self._path(key, "_SUCCESS")))

    def finished(self, key: str, inputs: str, fmt: str) -> bool:
        """Is the table there, made from the same inputs and in this format?"""
        note = self.note(key)
        return note is not None and (note["inputs"], note["format"]) == (inputs, fmt)

    def keys(self) -> list[str]:
        path, fs = self._path()
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []
        return sorted(n for n in names if self.has(n))

    def write(self, df: DataFrame, key: str, fmt: str = "parquet", inputs: str = "") -> None:
        """Write a table, and its note when all its rows are there."""
        write_table(df, f"{self.root}/{key}", fmt=fmt)
        path, fs = self._path(key, NOTE)
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps({"schema": df.schema.jsonValue(), "format": fmt, "inputs": inputs}).encode()))
        finally:
            out.close()

    def _format(self, key: str) -> str:
        path, fs = self._path(key)
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return "csv" if any(".csv" in n for n in names) else "parquet"

    def find(self, key: str) -> DataFrame | None:
        return self.table(key) if self.has(key) else None

    def table(self, key: str) -> DataFrame:
        if not self.has(key):
            raise FileNotFoundError(f"{self.root}/{key}: no finished table")
        note = self.note(key)
        if note is None:
            return read_table(self.spark, f"{self.root}/{key}", fmt=self._format(key))
        schema = StructType.fromJson(note["schema"])
        for field in schema.fields:
            field.nullable = True  # what was written is what there is: no value is checked again
        return read_table(self.spark, f"{self.root}/{key}", schema, note["format"])


def dashboards(published: Published) -> dict[str, DataFrame]:
    """D28-D35 from a folder of published tables, some of which may be absent.

    Without churn predictions the probability is 0 and the risk ``Unknown``; without
    recommendations the action is ``Not Assigned``; without profits the margin is 60 % and
    the months carry no profit; without segments they are ``Unknown``; without a forecast
    its KPIs and its table are left out.  An absent required table raises.
    """
    customers, transactions, customer_features = (published.table(k) for k in REQUIRED)
    have = {k: published.find(k) for k in OPTIONAL}
    profit, forecast = have["customer_profit"], have["combined_forecast"]
    # six tables read it
    master = stage_parquet(
        unified.master_customers(
            customer_features, transactions, have["churn_predictions"], have["retention_recommendations"], profit,
            have["rfm_segments_b"], have["behavioral_clusters"],
        ),
        "published-master",
    )
    months = stage_parquet(unified.monthly_business_summary(transactions, customers, master, profit), "published-months")
    out = {
        "master_customers": master,
        "monthly_business_summary": months,
        "fact_customer_metrics": unified.fact_customer_metrics(master),
        "dim_customer_attributes": unified.dim_customer_attributes(master),
        "dim_retention_actions": unified.dim_retention_actions(master),
        "fact_monthly_summary": months,
        "segment_summary": unified.segment_summary(master),
        "kpi_summary": unified.kpi_summary(master, months, forecast),
        "executive_kpis": unified.executive_kpis(customer_features, transactions, profit, have["churn_risk_summary"]),
        "customer_metrics": unified.customer_metrics(customer_features, have["churn_predictions"], have["rfm_segments_a"]),
    }
    if forecast is not None:
        out["fact_revenue_forecast"] = unified.fact_revenue_forecast(forecast)
    return out
