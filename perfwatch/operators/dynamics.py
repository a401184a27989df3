"""Short-term dynamics in file order: difference, change, rolling mean and std."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from perfwatch.operators.ordering import Layout, in_order
from perfwatch.operators.state import families_of, when_present

# The state columns that get dynamics.
DYNAMIC_SOURCES = [
    "p95_latency", "mean_latency", "max_latency", "cpu_total", "cpu_max",
    "memory_total", "memory_max", "resource_pressure", "net_rx_total", "net_tx_total", "net_total",
]


def dynamic_columns(columns: list[str], rolling_window: int = 3) -> dict[str, str]:
    """Name of each dynamic column and the state column it comes from."""
    suffixes = ["diff_1", "pct_change_1", f"rolling_mean_{rolling_window}", f"rolling_std_{rolling_window}"]
    return {f"{c}_{s}": c for c in DYNAMIC_SOURCES if c in columns for s in suffixes}


def add_dynamics(df: DataFrame, layout: Layout, rolling_window: int = 3, pos: str = "seq") -> DataFrame:
    """All dynamics of all present sources over one window (one exchange, one sort).

    A missing value or base, a zero base, and a deviation of fewer than two
    values give 0. The rolling mean stays missing over an empty frame until
    the final fill.
    """
    sources = [c for c in DYNAMIC_SOURCES if c in df.columns]

    def columns(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(1 - rolling_window, 0)
        out = {"_prev": F.lag(F.struct(*sources), 1).over(window)}
        for name in sources:
            out[f"{name}_rolling_mean_{rolling_window}"] = F.avg(name).over(frame)
            out[f"{name}_rolling_std_{rolling_window}"] = F.stddev_samp(name).over(frame)
        return out

    windowed = in_order(df, layout, pos, max(1, rolling_window - 1), 0, columns)
    out = {}
    for name in sources:
        std = f"{name}_rolling_std_{rolling_window}"
        zeroed = {
            f"{name}_diff_1": f"{name} - _prev.{name}",
            f"{name}_pct_change_1": f"try_divide({name}, _prev.{name}) - 1D",
            std: std,
        }
        out |= {c: when_present(families_of(name), f"coalesce({value}, 0D)") for c, value in zeroed.items()}
        out[f"{name}_rolling_mean_{rolling_window}"] = f"{name}_rolling_mean_{rolling_window}"
    return windowed.selectExpr(*df.columns, *[f"{out[c]} AS {c}" for c in dynamic_columns(sources, rolling_window)])
