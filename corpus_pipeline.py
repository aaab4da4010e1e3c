"""From raw documents to a weighted training mix, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all its
predecessor kept and calls one operator of ``tidemark.llm``; all but the last return
the columns of documents.  Stages that only read a text pack the row into one struct,
so no column of documents can clash with an operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, leaks, mixing, quality, simhash
from tidemark.llm.common import read, stage


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts; documents that are rejected go."""
    judged = quality.quality_rules(_packed(docs), carry=("row",)).where("kept")
    cut = F.col("lost_words") > 0
    row = F.when(cut, F.col("row").withField("text", F.col("clean_text"))).otherwise(F.col("row"))
    out = judged.withColumn("row", row)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("row", F.when(cut, F.col("row").withField("n_chars", F.length("clean_text").cast(kind))).otherwise(F.col("row")))
    return out.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    found = decontaminate.decontaminate(_packed(docs), read(spark, sf_dir, "benchmark"), carry=("row",), with_items=False)
    return found.where(~F.col("contaminated")).select("row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are replaced by a mark; widely copied examples stay."""
    return leaks.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes."""
    return mixing.digest(mixing.mix(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
]

#: SimHash components are not expressible in SQL;
#: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
