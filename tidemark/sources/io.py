"""Readers and sinks at the edge of the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from tidemark.sources.schema import require_columns


def _typed(name: str, source: DataType, target: DataType, required: bool) -> Column:
    """The column in its canonical type; text that doesn't parse becomes NULL, but never in a required column."""
    c = F.col(f"`{name}`")
    if source == target:
        out = c
    elif isinstance(source, StringType):
        out = F.expr(f"try_cast(trim(`{name}`) AS {target.simpleString()})")
    else:
        out = c.cast(target)
    if required:
        lost = c.isNotNull() & out.isNull()
        out = F.when(lost, F.raise_error(F.concat(F.lit(f"{name}: not a {target.simpleString()}: "), c.cast("string")))).otherwise(out)
    return out.alias(name)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str | None = None) -> DataFrame:
    """Read a canonical input from parquet or header CSV.

    Columns are matched by name: their order doesn't matter, more columns are left
    out, and a missing one raises ``ValueError``.  CSV values are read as text and
    cast to the schema; a value that doesn't parse is NULL, and an error in a
    column that the schema marks as not nullable (a key is never lost).
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    df = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    if schema is None:
        return df
    require_columns(df, schema, path)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_typed(f.name, types[f.name], f.dataType, not f.nullable) for f in schema.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite-write a published table (parquet by default, CSV with header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
