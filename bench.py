"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One pipeline run per process, like the reference's runner: the shared inputs
(cleaned customers / transactions, customer features, monthly series) are
staged once and timed as ``stage_inputs``; every query is then executed in
full with the ``noop`` sink (no driver collection).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import registry  # noqa: E402
from tidemark.session import cleanup_staged, local_session  # noqa: E402

HEADLINE = [
    "customer_features",
    "transaction_features",
    "daily_revenue",
    "monthly_revenue",
    "rfm_segments_a",
    "rfm_summary_b",
    "cohort_retention",
    "cohort_revenue",
    "lifecycle_summary",
    "customer_profit",
    "profit_tier_summary",
    "contribution_country",
    "retention_recommendations",
    "retention_action_summary",
    "decomposition",
    "combined_forecast",
    "forecast_metrics",
    "master_customers",
    "monthly_business_summary",
    "kpi_summary",
    "executive_kpis",
    "roc_curve",
    "behavioral_clusters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="tidemark-bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    t = registry.tables_for(spark, sf_dir)
    _ = (t.customers, t.transactions, t.customer_features, t.monthly_series)
    times["stage_inputs"] = round(time.perf_counter() - t0, 3)
    for name in names:
        q0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - q0, 3)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "pipeline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    cleanup_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
