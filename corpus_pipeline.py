"""The corpus job: documents in, training records out, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import decontaminate, mixing, simhash, toxicity, training_order
from faultline.llm.common import documents, read, stage
from faultline.llm.queries import toxicity_chain


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go."""
    return toxicity.accepted(docs, toxicity_chain(spark, docs, sf_dir), "toxic")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give a benchmark item away go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mixing.mixed(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as fixed-stride records in training order."""
    return training_order.training_order(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", weighted),
    ("token_records", token_records),
]

#: SimHash components, a trained classifier and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
