"""Run every published table of the reference pipeline and write it out.

    python -m tidemark.plans.runner --sf-dir /root/testdata/sf0.01 --out /shared/out
    python -m tidemark.plans.runner --customers c.csv --transactions t.csv --out /shared/out
    python -m tidemark.plans.runner --sf-dir /root/testdata/sf0.01 --out /shared/out --resume
    python -m tidemark.plans.runner --published /shared/out --out /shared/dashboards

Each table goes to ``<out>/<key>`` (parquet by default, CSV with header on
request).  The shared intermediate tables are computed once per run.  ``--resume`` goes on
after a run that broke off; ``--published`` makes the dashboards of what a run has written.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Iterable

from pyspark.sql import SparkSession

from tidemark.plans.catalog import Published, dashboards, input_mark
from tidemark.plans.context import Tables
from tidemark.plans.registry import TABLE_FUNCTIONS
from tidemark.sources.io import read_table
from tidemark.session import cleanup_staged
from tidemark.sources.schema import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA

ML_KEYS = {
    "churn_model_comparison",
    "churn_feature_importance",
    "churn_scores_ml",
    "behavioral_clusters",
    "cluster_profile",
    "silhouette_scores",
    "segmentation_dashboard",
    "forecast_arma",
    "arma_order_aic",
}


def run_all(
    tables: Tables,
    out_dir: str,
    fmt: str = "parquet",
    keys: Iterable[str] | None = None,
    include_ml: bool = True,
    resume: bool = False,
) -> dict[str, float]:
    """Write each selected table; returns seconds per table.

    With ``resume`` a table that is finished, of the same inputs and in this format stays
    as it is, and the cleaned tables among them are read instead of made again.
    """
    chosen = list(keys) if keys else [k for k in TABLE_FUNCTIONS if include_ml or k not in ML_KEYS]
    published = Published(tables.spark, out_dir)
    inputs = input_mark(tables.raw_customers, tables.raw_transactions)
    times: dict[str, float] = {}
    if resume:
        done = {k for k in TABLE_FUNCTIONS if published.finished(k, inputs, fmt)}
        tables.reuse(published, done)
        chosen = [k for k in chosen if k not in done]
    for k in chosen:
        t0 = time.perf_counter()
        published.write(TABLE_FUNCTIONS[k](tables), k, fmt, inputs)
        times[k] = round(time.perf_counter() - t0, 3)
    return times


def run_dashboards(published: Published, out_dir: str, fmt: str = "parquet") -> list[str]:
    """Write the dashboards that the published tables allow; returns their keys."""
    out = Published(published.spark, out_dir)
    made = dashboards(published)
    for k, df in made.items():
        out.write(df, k, fmt)
    return list(made)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--sf-dir", help="driver tables directory (adapter input)")
    ap.add_argument("--grain", default="lineitem", choices=["orders", "lineitem", "events"])
    ap.add_argument("--customers", help="canonical customers file (CSV or parquet)")
    ap.add_argument("--transactions", help="canonical transactions file (CSV or parquet)")
    ap.add_argument("--published", help="folder of a run's tables: write the dashboards they allow")
    ap.add_argument("--out", required=True)
    ap.add_argument("--resume", action="store_true", help="keep the tables a run has finished")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--skip-ml", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark-runner").getOrCreate()
    if a.published:
        print("\n".join(run_dashboards(Published(spark, a.published), a.out, a.format)))
        cleanup_staged(spark)
        return
    if a.customers and a.transactions:
        raw = (read_table(spark, a.customers, CUSTOMER_SCHEMA), read_table(spark, a.transactions, TRANSACTION_SCHEMA))
        tables = Tables(spark, raw=raw, fitted_clusters=not a.skip_ml)
    elif a.sf_dir:
        tables = Tables(spark, a.sf_dir, a.grain, fitted_clusters=not a.skip_ml)
    else:
        ap.error("give --sf-dir, --published, or --customers and --transactions")
    for k, sec in run_all(tables, a.out, a.format, a.keys or None, include_ml=not a.skip_ml, resume=a.resume).items():
        print(f"{k}\t{sec}")
    cleanup_staged(spark)  # every result is written: the staged intermediates can go


if __name__ == "__main__":
    main()
