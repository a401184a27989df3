"""Sinks: tables, stage outputs, JSON documents, previews and report exports."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATASET_DIR = "predictive_processed_dataset"
COMMITS_DIR = "predictive_processed_commits"
STAGE_PARTITIONS = ["part_name", "scenario", "logical_sample_key", "file_role"]


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV or Parquet by the suffix of ``path`` (a directory of part files)."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        df.write.mode(mode).parquet(path)
    elif suffix == "csv":
        df.write.mode(mode).option("header", "true").csv(path)
    else:
        raise ValueError(f"Unsupported table format .{suffix}; supported: .csv, .parquet")


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    if not path.rstrip("/").lower().endswith(".json"):
        raise ValueError(f"Metadata must be saved under a .json path: {path}")
    df.write.mode(mode).json(path)


def save_preview(df: DataFrame, path: str, order: list[str], rows: int = 20) -> None:
    save_table(preview(df, order, rows), path)


def preview(df: DataFrame, order: list[str], rows: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def output_parts(relpath: Column) -> dict[str, Column]:
    """Scenario, directory tail and stem of a source path.

    A file right under the root gives its own name as scenario.
    """
    parts = F.split(relpath, "/")
    tail = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), "/")
    return {
        "scenario": F.element_at(parts, 1),
        "tail": tail,
        "stem": F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", ""),
    }


def output_dir(relpath: Column, part_name: Column) -> Column:
    """``<dataset dir>/<part>/<scenario>[/<tail>]/<stem>`` of a source path."""
    made = output_parts(relpath)
    pieces = [F.lit(DATASET_DIR), part_name, made["scenario"], F.nullif(made["tail"], F.lit("")), made["stem"]]
    return F.concat_ws("/", *pieces)


def save_stage(df: DataFrame, root: str, role: str | Column, part_name: str = "part_0000_0000", kind: str = "parquet") -> None:
    """Write one stage under ``root`` partitioned by part, scenario, sample and role.

    ``role`` is a constant (``aggregated``, ``marked``, ``predictive``,
    ``metadata``) or the split column. Readers of one scenario, sample or role
    prune the rest. The samples and roles of ``df`` replace what was stored of
    them, so a second run or a retry gives the same files; all others stay.
    ``kind`` is parquet, csv or json.
    """
    of_role = F.lit(role) if isinstance(role, str) else role
    named = df.withColumns({
        "part_name": F.lit(part_name),
        "scenario": F.split("sample_key", "/")[0],
        "logical_sample_key": F.col("sample_key"),
        "file_role": of_role,
    })
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", "true")
    writer.partitionBy(*STAGE_PARTITIONS).format(kind).save(f"{root}/{DATASET_DIR}")


def new_version() -> str:
    """A version of stage outputs; later ones sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def versioned(part_name: str, version: str) -> str:
    """The part directory of one run. The manifest shows it under the plain name."""
    return f"{part_name}.v{version}"


def commit(samples: DataFrame, root: str, version: str) -> None:
    """Make a version the valid one of each of ``samples`` (sample_key, status), in one write after all stages.

    A record is a small file whose path holds the sample and the version. The
    files index takes files of a versioned part only if the last record of
    their sample names that version: a run without records changes nothing,
    and what an earlier run wrote of the same samples, in whatever part, is no
    longer read.
    """
    rows = samples.select("status", F.col("sample_key").alias("logical_sample_key"), F.lit(version).alias("version"))
    writer = rows.write.mode("append").partitionBy("logical_sample_key", "version").option("extension", "commit")
    writer.csv(f"{root}/{COMMITS_DIR}")


def load_stage(spark: SparkSession, schema: T.StructType, root: str, role: str, part_name: str) -> DataFrame:
    """One stage back: the partition filters prune all other files.

    Stages differ in their columns, so the schema of the wanted one is given.
    """
    keys = [T.StructField(c, T.StringType()) for c in STAGE_PARTITIONS]
    reader = spark.read.schema(T.StructType([*schema.fields, *keys])).option("pathGlobFilter", "*.parquet")
    stored = reader.parquet(f"{root}/{DATASET_DIR}")
    return stored.where((F.col("file_role") == role) & (F.col("part_name") == part_name)).drop(*STAGE_PARTITIONS)


def export_report(df: DataFrame, path: str) -> None:
    """CSV export of a report, in as many files as it has partitions."""
    df.write.mode("overwrite").option("header", "true").csv(path)
