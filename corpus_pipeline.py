"""A training-data pipeline over ``documents``: five stages, each one corpus operator.

Every stage takes the documents its predecessor kept, as Parquet in the shared
folder, and decides over all of them. The first four return rows of documents
unchanged; the last one returns the shard and slot of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perfwatch.llm import decontaminate, language_id, mixing, near_duplicates, sharding
from perfwatch.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or a sure prediction go."""
    return language_id.identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target weights of sources, languages and topics."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document along the Hilbert curve."""
    return sharding.shards(docs)


STAGES = [
    ("language", language), ("deduplicate", deduplicate), ("decontamination", decontamination), ("mix", mix), ("shard", shard),
]
#: Language prediction, signatures and retrieval have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
