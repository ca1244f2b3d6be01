"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trajtable.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from trajtable.llm.common import table, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels of the training folds."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.without_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dedup.without_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that are left."""
    return bpe.encode(docs, keep=["doc_id", "lang", "source"])


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", benchmark), ("bpe", tokens)]
ORACLE_SQL = None  # learned scores and sampled sketches have no SQL; tests compare with plain loops


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
