"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import ensure_checkpoint_dir, track_staged

#: White space of the word rule ``[^\x20\x09-\x0D]+`` as a Java character class.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once under the session's checkpoint folder and read it back.

    The folder is the cluster's shared one (``spark.checkpoint.dir``), so a lost
    executor costs only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    track_staged(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    fields: list[tuple[str, pa.DataType]],
    text: str = "text",
    step: int = 1024,
) -> DataFrame:
    """Run ``make()`` once per task, then its result on the texts of every batch, ``step`` at a time.

    The function gets the batch's texts (null becomes the empty string) and
    returns one list per field.  All columns of ``df`` but the text pass through.
    """
    keep = [f for f in df.schema.fields if f.name != text]
    ddl = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double", pa.binary(): "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                got = fn([t or "" for t in part.column(at).to_pylist()])
                rest = [(n, c) for i, (n, c) in enumerate(zip(part.schema.names, part.columns)) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [c for _, c in rest] + [pa.array(got[n], type=t) for n, t in fields],
                    names=[n for n, _ in rest] + [n for n, _ in fields],
                )

    def spark_type(t: pa.DataType) -> str:
        if pa.types.is_list(t):
            return f"array<{spark_type(t.value_type)}>"
        if pa.types.is_struct(t):
            return "struct<" + ",".join(f"{f.name}:{spark_type(f.type)}" for f in t) + ">"
        return ddl[t]

    added = StructType.fromDDL(", ".join(f"`{n}` {spark_type(t)}" for n, t in fields))
    return df.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in keep] + added.fields))
