"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legmeter.llm import decontaminate, near_duplicates, packing, quality, substrings
from legmeter.llm.queries import WORD_TOKENIZER
from legmeter.session import work_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or the threshold rules go."""
    return quality.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return near_duplicates.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds are taken out; the documents stay."""
    return substrings.strip_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids."""
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Sampling, tokenizing and packing are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stage stored and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
