"""Registered queries of the corpus operators: one thin query for each contract.

A query reads its whole table, applies its operator with production parameters
and derives the contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import conversations, decontaminate, leaks, mixing, pages, phrases, pii, quality, simhash, substrings, toxicity, urls, warc
from tidemark.llm.common import read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.simhash_components(read(spark, sf_dir, "documents")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect_pii(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(read(spark, sf_dir, "documents")))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(read(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    return urls.judge_urls(read(spark, sf_dir, "pages"), rules)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.quality_rules(read(spark, sf_dir, "documents"), with_text=False))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.digest(leaks.scan_secrets(read(spark, sf_dir, "documents")))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(read(spark, sf_dir, "documents")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.through_archives(read(spark, sf_dir, "pages")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damage(read(spark, sf_dir, "conversations")), "copies")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_mixing": op3_mixing,
    "op4_html_text": op4_html_text,
    "op5_decontaminate": op5_decontaminate,
    "op6_url_rules": op6_url_rules,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_secrets": op9_secrets,
    "op10_substrings": op10_substrings,
    "op11_warc": op11_warc,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {"op6_url_rules": urls.ORACLE, "op11_warc": warc.ORACLE, "op13_collocations": phrases.ORACLE}
