"""The registered queries of the corpus operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from perfwatch.llm import (
    collocations,
    decontaminate,
    filter_audit,
    html_text,
    language_id,
    licenses,
    mixing,
    near_duplicates,
    quality_model,
    quality_rules,
    secret_scan,
    sharding,
    sql,
    vector_graph,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of every document that leaks a benchmark item."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("text_hash")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_decontamination, op2_language_id, op3_quality_rules, op4_license_scan, op5_near_duplicates, op6_mixing,
    op7_secret_scan, op8_html_extraction, op9_sharding, op10_quality_classifier, op11_vector_duplicates, op12_collocations, op13_filter_audit, pipeline,
)
_ORACLES = {
    "op3_quality_rules": sql.QUALITY_RULES, "op4_license_scan": sql.LICENSES, "op5_near_duplicates": sql.NEAR_DUPLICATES,
    "op12_collocations": sql.COLLOCATIONS, "op13_filter_audit": sql.FILTER_AUDIT,
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
