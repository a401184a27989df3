"""From wide telemetry to labelled state and the predictive dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.dynamics import add_dynamics, dynamic_columns
from perfwatch.operators.families import family_columns, mark_available
from perfwatch.operators.labels import apply_thresholds, label_summary, thresholds
from perfwatch.operators.ordering import Layout, by_group_size, join_on
from perfwatch.operators.predictive import predictive_dataset
from perfwatch.operators.state import fill_state, system_state
from perfwatch.operators.validation import sample_status


@dataclass(frozen=True)
class Settings:
    """Parameters of preprocessing."""

    rolling_window: int = 3
    anomaly_quantile: float = 0.95
    n_lags: int = 3
    horizon: int = 1
    min_rows: int = 10
    train: float = 0.70
    val: float = 0.15
    test: float = 0.15
    require_measures: bool = False


ORDER = ("sample_key", "seq", "n")


@by_group_size
def aggregated(telemetry: DataFrame, layout: Layout, settings: Settings = Settings()) -> DataFrame:
    """System state with dynamics, zero-filled, in file order ``seq``.

    ``telemetry`` has ``sample_key`` and ``seq`` (and ``n``, if it is known).
    """
    return _with_dynamics(system_state(telemetry, ORDER), layout, settings)


def _with_dynamics(state: DataFrame, layout: Layout, settings: Settings) -> DataFrame:
    moving = add_dynamics(state, layout, settings.rolling_window)
    return fill_state(moving, dynamic_columns(moving.columns, settings.rolling_window))


@by_group_size
def marked(telemetry: DataFrame, layout: Layout, settings: Settings = Settings()) -> DataFrame:
    """Aggregated state with anomaly flags.

    Thresholds read the undecorated state, so their pass neither sorts the
    samples nor computes dynamics, and scans three families only.
    """
    state = system_state(telemetry, ORDER)
    limits = thresholds(fill_state(state), layout, settings.anomaly_quantile, settings.train)
    return apply_thresholds(_with_dynamics(state, layout, settings), limits, list(layout.keys))


@by_group_size
def predictive(telemetry: DataFrame, layout: Layout, settings: Settings = Settings()) -> DataFrame:
    return predictive_dataset(
        marked(telemetry, layout, settings), layout, settings.n_lags, settings.horizon,
        settings.train, settings.val, settings.test,
    )


def status(telemetry: DataFrame, dataset: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per sample: rows after each stage, gate result and reason."""
    flags = ["latency_available", "cpu_available", "memory_available"]
    sizes = mark_available(telemetry).groupBy("sample_key").agg(
        F.count(F.lit(1)).alias("aggregated_rows"), *[F.max(c).alias(c) for c in flags]
    )
    made = dataset.groupBy("sample_key").agg(F.count(F.lit(1)).alias("predictive_rows"))
    joined = join_on(sizes, made, ["sample_key"], "left").withColumn(
        "predictive_rows", F.coalesce("predictive_rows", F.lit(0))
    )
    return sample_status(joined, settings.min_rows, settings.require_measures).drop(*flags)


def audit(telemetry: DataFrame, labelled: DataFrame, lag_columns: int) -> DataFrame:
    """One row per sample: source and state rows, matched columns, label summary, lag count."""
    found = family_columns(telemetry)
    matched = telemetry.groupBy("sample_key").agg(
        F.count(F.lit(1)).alias("row_count_source"),
        *[
            F.when(F.max(f"{family}_available") == 1, F.lit(", ".join(cols))).otherwise(F.lit("")).alias(f"{family}_columns")
            for family, cols in found.items()
        ],
    )
    summary = label_summary(labelled, ["sample_key"]).withColumnRenamed("row_count", "row_count_aggregated")
    return join_on(matched, summary, ["sample_key"]).withColumn("lag_columns_count", F.lit(lag_columns))


def sample_metadata(telemetry: DataFrame, labelled: DataFrame, limits: DataFrame, dataset: DataFrame) -> DataFrame:
    """One document per sample: columns, thresholds, label summary, and rows of the dataset and its splits."""
    lags = sum("_lag_" in c for c in dataset.columns)
    rows = dataset.groupBy("sample_key").agg(
        F.count(F.lit(1)).alias("row_count_predictive"),
        *[F.count_if(F.col("split") == part).alias(f"{part}_rows") for part in ("train", "val", "test")],
    )
    described = join_on(audit(telemetry, labelled, lags), limits, ["sample_key"])
    return join_on(described, rows, ["sample_key"])
