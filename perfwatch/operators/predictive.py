"""Lags, future targets, complete rows and the chronological split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.functions.scalars import part_of
from perfwatch.operators.families import numeric_columns
from perfwatch.operators.ordering import Layout, by_group_size, in_order, positions
from perfwatch.operators.validation import check_split_fractions

# Target name of each source; the names keep t_plus_1 for any horizon.
TARGETS = {
    "system_anomaly": "target_anomaly_t_plus_1",
    "latency_anomaly": "target_latency_anomaly_t_plus_1",
    "cpu_anomaly": "target_cpu_anomaly_t_plus_1",
    "memory_anomaly": "target_memory_anomaly_t_plus_1",
    "p95_latency": "target_p95_latency_t_plus_1",
    "label_trace": "target_label_trace_t_plus_1",
}
# Columns that get no lags.
NOT_LAGGED = [
    "window_id", "trace_id", "label_trace",
    "latency_anomaly", "cpu_anomaly", "memory_anomaly", "system_anomaly",
]
ORDER_COLUMNS = ["sample_key", "seq", "pos", "n"]


def lag_base(df: DataFrame) -> list[str]:
    """Numeric columns that get lags."""
    return [c for c in numeric_columns(df, NOT_LAGGED + ORDER_COLUMNS) if not c.startswith("target_")]


def ordered_by_window(df: DataFrame, layout: Layout) -> DataFrame:
    """Add ``pos`` and ``n``: order by window, file order breaking ties."""
    return positions(df, layout, ["window_id", "seq"], "pos", "n")


def add_history(
    df: DataFrame, layout: Layout, n_lags: int = 3, horizon: int = 1, base: list[str] | None = None
) -> DataFrame:
    """Struct columns ``lag_1..lag_n`` and the future targets, over one window.

    Structs keep the plan narrow: every lag of every column is one window
    expression. ``flatten_lags`` spreads them at the sink.
    """
    if horizon < 1:
        raise ValueError("The forecast horizon must be at least 1: 0 would leak the present.")
    names = lag_base(df) if base is None else base
    targets = {s: t for s, t in TARGETS.items() if s in df.columns}

    def columns(window: WindowSpec) -> dict[str, Column]:
        lags = {f"lag_{k}": F.lag(F.struct(*names), k).over(window) for k in range(1, n_lags + 1)}
        return {**lags, **{t: F.lead(s, horizon).over(window) for s, t in targets.items()}}

    return in_order(df, layout, "pos", n_lags, horizon, columns)


def complete_rows(df: DataFrame, n_lags: int = 3, horizon: int = 1) -> DataFrame:
    """Rows with a full history and future, told by their position.

    A text label that is missing at the target row drops the row as well.
    """
    kept = df.where((F.col("pos") >= n_lags) & (F.col("pos") < F.col("n") - horizon))
    if _text_label(kept):
        kept = kept.where(F.col(TARGETS["label_trace"]).isNotNull())
    return kept


def _text_label(df: DataFrame) -> bool:
    target = TARGETS["label_trace"]
    return target in df.columns and isinstance(df.schema[target].dataType, T.StringType)


def split_of(place: Column, rows: Column, train: float, val: float) -> Column:
    """``train``/``val``/``test`` by position; sizes truncate, the rest is test."""
    train_end = part_of(rows, train)
    val_end = train_end + part_of(rows, val)
    return (
        F.when(place < train_end, F.lit("train")).when(place < val_end, F.lit("val")).otherwise(F.lit("test"))
    )


def chronological_split(
    df: DataFrame,
    layout: Layout,
    n_lags: int = 3,
    horizon: int = 1,
    train: float = 0.70,
    val: float = 0.15,
    test: float = 0.15,
) -> DataFrame:
    """Add ``split`` to the complete rows."""
    check_split_fractions(train, val, test)
    if _text_label(df):
        # rows were dropped by value, so places must be counted anew
        renumbered = positions(df.drop("n").withColumnRenamed("pos", "_old"), layout, ["_old"], "pos", "n")
        return renumbered.drop("_old").withColumn("split", split_of(F.col("pos"), F.col("n"), train, val))
    rows = F.greatest(F.col("n") - n_lags - horizon, F.lit(0))
    return df.withColumn("split", split_of(F.col("pos") - n_lags, rows, train, val))


@by_group_size
def predictive_dataset(
    labelled: DataFrame,
    layout: Layout,
    n_lags: int = 3,
    horizon: int = 1,
    train: float = 0.70,
    val: float = 0.15,
    test: float = 0.15,
) -> DataFrame:
    """Complete rows with lags, targets and the split."""
    ordered = ordered_by_window(labelled.drop("pos", "n"), layout)
    kept = complete_rows(add_history(ordered, layout, n_lags, horizon), n_lags, horizon)
    return chronological_split(kept, layout, n_lags, horizon, train, val, test)


def flatten_lags(df: DataFrame) -> DataFrame:
    """Spread the lag structs into ``<column>_lag_<k>`` columns."""
    fields = df.schema.fields
    lags = [f for f in fields if f.name.startswith("lag_") and isinstance(f.dataType, T.StructType)]
    plain = [f"`{f.name}`" for f in fields if f not in lags]
    lags.sort(key=lambda f: int(f.name.removeprefix("lag_")))
    spread = [f"{f.name}.`{c}` AS `{c}_{f.name}`" for f in lags for c in f.dataType.names]
    return df.selectExpr(*plain, *spread)
