"""Ordered work inside a sample without putting a whole sample in one task.

A sample (one trace or run) is the unit of time order, and one sample may hold
a large part of all rows. ``measure`` counts the groups once. Groups that fit a
task take a plain window over the key, the cheapest plan (one exchange). The
others are listed, and only their rows are range-partitioned on (key, order),
numbered from the partition offsets, and windowed on fixed-length chunks of the
order that carry the few neighbouring rows their frames need. ``by_group_size``
sends each row down its way once, for a whole chain of such steps.
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from perfwatch.session import stage

GROUP_LIMIT = 1_000_000
CHUNK_ROWS = 250_000


@dataclass(frozen=True)
class Layout:
    """How the rows of one group are spread: one window partition, or chunks.

    With ``heavy`` (one row of keys for each large group) only these groups are
    split; without it a split layout splits all.
    """

    keys: tuple[str, ...]
    split: bool = False
    chunk: int = CHUNK_ROWS
    heavy: DataFrame | None = field(default=None, compare=False)

    def by(self, *keys: str) -> "Layout":
        return Layout(keys, self.split, self.chunk)


def by_group_size(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Decorator: small groups take the plain layout, large ones the split one, and the results are united.

    ``build(df, layout, ...)`` must treat each group by itself. Steps called
    within it find their layout settled, so a chain of steps is routed once.
    The list of large groups has at most rows / limit entries.
    """
    place = list(inspect.signature(build).parameters).index("layout")

    @functools.wraps(build)
    def routed(df: DataFrame, *args, **named) -> DataFrame:
        args = [df, *args]
        layout = named["layout"] if "layout" in named else args[place] if place < len(args) else None
        if layout is None or not layout.split or layout.heavy is None:
            return build(*args, **named)

        def over(rows: DataFrame, own: Layout) -> DataFrame:
            given = [rows, *args[1:]]
            if "layout" in named:
                return build(*given, **(named | {"layout": own}))
            given[place] = own
            return build(*given, **named)

        keys = list(layout.keys)
        small = over(join_on(df, layout.heavy, keys, "left_anti"), Layout(layout.keys))
        large = over(join_on(df, layout.heavy, keys, "left_semi"), replace(layout, heavy=None))
        return small.unionByName(large)

    return routed


def join_on(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet each other, as they do in a window or a grouping."""
    keys = list(keys)
    other = right.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    met = reduce(Column.__and__, [left[k].eqNullSafe(other[f"__on_{k}"]) for k in keys], F.lit(True))
    return left.join(other, met, how).drop(*[f"__on_{k}" for k in keys])


def fits_task(rows: int, limit: int | None = None) -> bool:
    """True if that many rows may stand in one window partition."""
    return rows <= (GROUP_LIMIT if limit is None else limit)


def _layout(counts: DataFrame, keys: tuple[str, ...], size: str, limit: int | None) -> Layout:
    """Plain if the largest count fits a task; else with the stored keys of those that do not."""
    biggest = counts.agg(F.max(size)).first()[0] or 0
    if fits_task(biggest, limit):
        return Layout(keys)
    over = counts.where(F.col(size) > (GROUP_LIMIT if limit is None else limit)).select(*keys)
    return Layout(keys, True, heavy=stage(over, "heavy"))


def measure(df: DataFrame, keys: list[str] | tuple[str, ...], limit: int | None = None) -> Layout:
    """Count the groups (map-side combined; one number reaches the driver)."""
    if keys:
        return _layout(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")), tuple(keys), "count", limit)
    return Layout((), not fits_task(df.count(), limit))


def measure_nested(
    df: DataFrame, outer: list[str], inner: list[str], limit: int | None = None
) -> tuple[Layout, Layout]:
    """Layouts of the inner groups, and of the outer groups over one row per inner group."""
    counts = df.groupBy(*inner).agg(F.count(F.lit(1)).alias("count"))
    sizes = counts.groupBy(*outer).agg(F.max("count").alias("a"), F.count("count").alias("b"))
    rows, groups = sizes.agg(F.max("a"), F.max("b")).first()
    inside = Layout(tuple(inner)) if fits_task(rows or 0, limit) else _layout(counts, tuple(inner), "count", limit)
    return inside, Layout(tuple(outer)) if fits_task(groups or 0, limit) else _layout(sizes, tuple(outer), "b", limit)


@by_group_size
def positions(
    df: DataFrame,
    layout: Layout,
    order: list[Column | str],
    pos: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """Add the 0-based place of each row in its group and, on request, the group size.

    ``order`` must be a total order within the group.
    """
    keys = list(layout.keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if not layout.split:
        added = {pos: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1}
        if total:
            added[total] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return df.withColumns(added)
    by_range = [F.col(k) for k in keys] + order
    numbered = stage(
        df.repartitionByRange(*by_range)
        .sortWithinPartitions(*by_range)
        .withColumn("__place", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftrightunsigned("__place", 33)),
        "ordered",
    )
    parts = numbered.groupBy(*keys, "__part").agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    # one row per (group, range partition): small even when the group is not
    in_group = Window.partitionBy(*keys)
    earlier = in_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({
        "__before": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)),
        "__total": F.sum("__rows").over(in_group),
    })
    out = join_on(numbered, parts, [*keys, "__part"]).withColumn(
        pos, F.col("__place") - F.col("__first") + F.col("__before")
    )
    if total:
        out = out.withColumn(total, F.col("__total"))
    return out.drop("__place", "__part", "__first", "__rows", "__before", "__total")


@by_group_size
def in_order(
    df: DataFrame,
    layout: Layout,
    pos: str,
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Add window columns over the order ``pos`` of each group.

    ``columns(window)`` may look ``before`` rows back and ``after`` rows ahead.
    """
    keys = list(layout.keys)
    if not layout.split:
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(pos)))
    size = layout.chunk
    if max(before, after) > size:
        raise ValueError("The frame is longer than a chunk.")
    own = F.floor(F.col(pos) / F.lit(size))
    offset = F.col(pos) % F.lit(size)
    homes = F.array_compact(F.array(
        own,
        F.when(offset >= size - before, own + 1),
        F.when((offset < after) & (own > 0), own - 1),
    ))
    spread = df.withColumn("__chunk", F.explode(homes))
    added = spread.withColumns(columns(Window.partitionBy(*keys, "__chunk").orderBy(pos)))
    return added.where(F.col("__chunk") == own).drop("__chunk")


def group_sizes(df: DataFrame, keys: list[str], total: str = "n") -> DataFrame:
    """Add the group size by a pre-aggregated count and an equi-join."""
    return join_on(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total)), keys)


@by_group_size
def running_total(
    df: DataFrame, layout: Layout, order: list[str], value: str, out: str = "running"
) -> DataFrame:
    """Inclusive running sum of ``value`` along a total order in each group."""
    keys = list(layout.keys)
    upto = (Window.unboundedPreceding, 0)
    if not layout.split:
        run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumn(out, F.sum(value).over(run))
    ranged = stage(
        df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "running"
    )
    parts = ranged.groupBy(*keys, "__part").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    local = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(*upto)
    return (
        join_on(ranged, parts, [*keys, "__part"])
        .withColumn(out, F.col("__before") + F.sum(value).over(local))
        .drop("__part", "__before")
    )
