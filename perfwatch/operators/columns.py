"""Column lists driven by the schema: select, drop, features, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.families import numeric_columns
from perfwatch.operators.validation import require_target

# Columns that never enter a model.
SOURCE_COLUMNS = [
    "source_file", "source_relpath", "source_level_1", "source_level_2", "source_level_3",
    "dataset_name", "part_name", "logical_sample_key", "file_name", "file_suffix", "file_role",
    "parent_dir_name", "absolute_path", "relative_path_from_part",
]
SERVICE_COLUMNS = [
    "trace_id", "label_trace", "latency_anomaly", "cpu_anomaly", "memory_anomaly", "system_anomaly",
]
# Columns this library adds to order and identify rows.
LAYOUT_COLUMNS = ["dataset_source_path", "sample_key", "seq", "pos", "n", "split"]


def drop_existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def select_existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def numeric_only(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Numeric columns, then the ``keep`` columns that exist."""
    names = numeric_columns(df)
    names += [k for k in keep or [] if k in df.columns and k not in names]
    return df.select(*names)


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Numeric columns a model for ``target`` may use."""
    require_target(df, target)
    banned = {*SOURCE_COLUMNS, *SERVICE_COLUMNS, *LAYOUT_COLUMNS, target}
    return [c for c in numeric_columns(df) if c not in banned and not c.startswith("target_")]


def features_and_target(df: DataFrame, target: str) -> DataFrame:
    return df.select(*feature_columns(df, target), target)


def align(df: DataFrame, train_columns: list[str]) -> DataFrame:
    """The train columns in the train order; missing ones become 0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in train_columns])
