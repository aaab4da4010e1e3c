"""Exact ``describe()`` of numeric columns (count, mean, std, min, quartiles, max), long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import favg
from tidemark.functions.ranking import exact_quantiles_many

STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, stat, value) rows as pandas ``describe`` gives them, with exact quartiles.

    Spark's ``DataFrame.summary`` uses approximate percentiles; here the quartiles
    of all columns come from ``exact_quantiles_many`` and equal the
    linear-interpolated pandas values.
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.count(c).cast("double").alias(f"count{i}"), favg(c).alias(f"mean{i}"), F.stddev_samp(c).alias(f"std{i}"),
            F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}"),
        ]
    body = ", ".join(f"'{c}', '{s}', {s}{i}" for i, c in enumerate(cols) for s in ("count", "mean", "std", "min", "max"))
    base = df.agg(*aggs).select(F.expr(f"stack({5 * len(cols)}, {body}) AS (column, stat, value)"))
    quartiles = exact_quantiles_many(df, {c: [0.25, 0.5, 0.75] for c in cols})
    names = F.element_at(F.array(F.lit("25%"), F.lit("50%"), F.lit("75%")), F.col("k") + 1)
    return base.unionByName(quartiles.select("column", names.alias("stat"), "value"))
