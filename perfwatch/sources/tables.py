"""Scans that shape rows: caps, seeded samples, unions of different headers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.ordering import Layout, positions


def unite(frames: dict[str, DataFrame], path_column: str = "dataset_source_path") -> DataFrame:
    """Union by name; missing columns become NULL; each row keeps its source."""
    named = [df.withColumn(path_column, F.lit(path)) for path, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def capped(df: DataFrame, rows: int | None, pos: str = "seq") -> DataFrame:
    """The first rows of each source by their place: a plain filter, no window."""
    return df if rows is None else df.where(F.col(pos) < rows)


def sampled(
    df: DataFrame, layout: Layout, fraction: float | None, seed: int = 42, pos: str = "seq", total: str = "n"
) -> DataFrame:
    """``round(fraction * n)`` rows of each source, drawn by a seeded hash of the row.

    The same seed draws the same rows whatever the partitioning. A source of
    one row is kept whole.
    """
    if fraction is None or not 0 < fraction < 1:
        return df
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(k) for k in layout.keys], F.col(pos).cast("string"))
    drawn = positions(df.withColumn("_hash", F.md5(key)), layout, ["_hash", pos], "_draw")
    size = F.bround(F.lit(float(fraction)) * F.col(total), 0)
    return drawn.where((F.col(total) <= 1) | (F.col("_draw") < size)).drop("_hash", "_draw")
