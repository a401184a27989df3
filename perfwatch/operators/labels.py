"""Anomaly flags from quantile thresholds learned on the chronological prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.functions.scalars import part_of
from perfwatch.operators.ordering import Layout, by_group_size, group_sizes, join_on
from perfwatch.operators.quantile import exact_quantiles
from perfwatch.operators.validation import check_prefix_fraction

# Candidate indicators in order of preference.
INDICATORS = {
    "latency": ["p95_latency", "max_latency", "mean_latency"],
    "cpu": ["cpu_total", "cpu_max", "cpu_mean"],
    "memory": ["memory_total", "memory_max", "memory_mean"],
}
FLAGS = ["latency_anomaly", "cpu_anomaly", "memory_anomaly", "system_anomaly"]


def indicators(df: DataFrame) -> dict[str, str | None]:
    """The first existing candidate column of each indicator."""
    return {name: next((c for c in cands if c in df.columns), None) for name, cands in INDICATORS.items()}


def in_prefix(rows: Column, place: Column, fraction: float) -> Column:
    """True for the first ``max(1, int(rows * fraction))`` rows."""
    return place < F.greatest(F.lit(1), part_of(rows, fraction))


def training_prefix(df: DataFrame, keys: list[str], fraction: float = 0.70, pos: str = "seq") -> DataFrame:
    """The chronological first part of each sample, in file order."""
    check_prefix_fraction(fraction)
    sized = df if "n" in df.columns else group_sizes(df, keys)
    return sized.where(in_prefix(F.col("n"), F.col(pos), fraction))


@by_group_size
def thresholds(
    df: DataFrame, layout: Layout, quantile: float = 0.95, fraction: float = 0.70, pos: str = "seq"
) -> DataFrame:
    """One row per sample: settings, chosen columns, threshold values."""
    chosen = {name: column for name, column in indicators(df).items() if column}
    needed = df.select(*layout.keys, pos, *[c for c in ("n",) if c in df.columns], *chosen.values())
    prefix = training_prefix(needed, list(layout.keys), fraction, pos)
    found = exact_quantiles(
        prefix, layout, {f"{name}_threshold": (column, quantile) for name, column in chosen.items()}
    )
    settings = {
        "anomaly_quantile": F.lit(float(quantile)),
        "train_frac_for_thresholds": F.lit(float(fraction)),
    }
    for name in INDICATORS:
        threshold = f"{name}_threshold"
        if name in chosen:
            settings[f"{name}_column"] = F.when(F.col(threshold).isNotNull(), F.lit(chosen[name]))
        else:
            settings[f"{name}_column"] = F.lit(None).cast("string")
            settings[threshold] = F.lit(None).cast("double")
    return found.withColumns(settings)


def apply_thresholds(df: DataFrame, limits: DataFrame, keys: list[str]) -> DataFrame:
    """Flag values at or above the threshold of their sample.

    The join has one row per sample on the right; the planner broadcasts it
    when it is small and otherwise splits skewed samples.
    """
    names = [f"{name}_threshold" for name in INDICATORS]
    joined = join_on(df, limits.select(*keys, *names), keys, "left")
    chosen = indicators(df)
    flags = {}
    for name in INDICATORS:
        if chosen[name]:
            over = F.col(chosen[name]) >= F.col(f"{name}_threshold")
            flags[f"{name}_anomaly"] = F.coalesce(over.cast("int"), F.lit(0))
        else:
            flags[f"{name}_anomaly"] = F.lit(0)
    labelled = joined.withColumns(flags).drop(*names)
    return labelled.withColumn(
        "system_anomaly", F.greatest("latency_anomaly", "cpu_anomaly", "memory_anomaly")
    )


@by_group_size
def label(
    df: DataFrame, layout: Layout, quantile: float = 0.95, fraction: float = 0.70, pos: str = "seq"
) -> DataFrame:
    return apply_thresholds(df, thresholds(df, layout, quantile, fraction, pos), list(layout.keys))


def label_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count, and count and share of each flag, per sample."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for flag in (f for f in FLAGS if f in df.columns):
        aggs += [F.sum(flag).alias(f"{flag}_count"), F.avg(flag).alias(f"{flag}_share")]
    return df.groupBy(*keys).agg(*aggs)
