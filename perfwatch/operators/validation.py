"""Checks of schemas, values and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
SCENARIOS = ["compose", "home", "user"]
FILE_ROLES = ["aggregated", "marked", "predictive", "train", "val", "test", "metadata"]
MANIFEST_COLUMNS = ["absolute_path", "file_role", "relative_path_from_part"]


def require_columns(df: DataFrame, names: list[str], what: str = "DataFrame") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks required columns {missing}; available: {df.columns}")
    return df


def require_target(df: DataFrame, target: str, what: str = "dataset") -> DataFrame:
    if target not in df.columns:
        like = [c for c in df.columns if c.startswith("target_")]
        raise KeyError(f"Target {target!r} is not in {what}; targets there: {like}")
    return df


def require_rows(df: DataFrame, what: str = "DataFrame") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty.")
    return df


def check_split_fractions(train: float, val: float, test: float, tolerance: float = 1e-6) -> None:
    parts = {"train": train, "val": val, "test": test}
    if abs(sum(parts.values()) - 1.0) > tolerance:
        raise ValueError(f"Split fractions must sum to 1: {parts}")
    for name, value in parts.items():
        if not 0 <= value <= 1:
            raise ValueError(f"{name} fraction must lie in [0, 1]: {value}")


def check_prefix_fraction(fraction: float) -> None:
    if not 0 < fraction <= 1:
        raise ValueError(f"The training prefix must be a fraction in (0, 1]: {fraction}")


def probability_violations(df: DataFrame, column: str) -> DataFrame:
    """One row: values of ``column`` outside [0, 1]."""
    p = F.col(column)
    return df.agg(
        F.count_if((p < 0) | (p > 1)).alias("outside_unit_range"), F.count(p).alias("checked_values")
    )


def require_probabilities(df: DataFrame, column: str) -> DataFrame:
    outside = probability_violations(df, column).first()[0]
    if outside:
        raise ValueError(f"{column} has {outside} values outside [0, 1].")
    return df


def unexpected_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values of ``column`` that are not allowed, with their row counts."""
    return df.where(~F.col(column).isin(allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def require_allowed(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    found = unexpected_values(df, column, allowed)
    kinds, rows = found.agg(F.count(F.lit(1)), F.sum("row_count")).first()
    if kinds:
        shown = [r[0] for r in found.orderBy(F.desc("row_count"), column).limit(20).collect()]
        more = f" and {kinds - len(shown)} more values" if kinds > len(shown) else ""
        raise ValueError(f"Unsupported {column} in {rows} rows: {shown}{more}; allowed: {allowed}")
    return df


def sample_status(
    sizes: DataFrame,
    min_rows: int = 10,
    require_measures: bool = False,
) -> DataFrame:
    """Status of each sample from its row counts after each stage.

    ``sizes`` has ``aggregated_rows`` and ``predictive_rows``. The optional
    suitability gate also asks for latency and one of CPU and memory
    (``latency_available``, ``cpu_available``, ``memory_available``).
    """
    gates = [
        (F.col("aggregated_rows") < min_rows, "too few rows after aggregation"),
        (F.col("predictive_rows") < min_rows, "too few rows after predictive processing"),
    ]
    if require_measures:
        usable = (F.col("latency_available") == 1) & (
            (F.col("cpu_available") == 1) | (F.col("memory_available") == 1)
        )
        gates.insert(0, (~usable, "required metrics are missing"))
    reason = F.coalesce(*[F.when(test, F.lit(text)) for test, text in gates])
    return sizes.withColumns({
        "status": F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("failed")),
        "reason": reason,
    })


def run_totals(status: DataFrame) -> DataFrame:
    """One row: processed and failed samples."""
    return status.agg(
        F.count_if(F.col("status") == "ok").alias("processed_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
    )


def require_success(status: DataFrame) -> DataFrame:
    """A run fails only if no sample succeeded."""
    if run_totals(status).first()["processed_count"] == 0:
        raise RuntimeError("No sample was processed.")
    return status
