"""Exact linear-interpolated quantiles of groups of any size.

Groups that fit a task use the built-in exact ``percentile``. The ranks of
larger ones are found by refining histograms: values between the least and the
greatest candidate are counted in ``BINS`` bins, the bin that holds the rank
gives the next candidates, and so on until only equal values are left. A round
is a map-side combined count of at most BINS rows a task, group and quantile;
from the second round on it reads only the values of the chosen bins. No task
holds a group, and nothing is sorted but the bins of one quantile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.operators.ordering import Layout, by_group_size, join_on
from perfwatch.session import stage

BINS = 1024


@by_group_size
def exact_quantiles(
    df: DataFrame, layout: Layout, wanted: dict[str, tuple[str, float]]
) -> DataFrame:
    """One row per group with ``{name: quantile q of column}``; NULLs are skipped."""
    keys = list(layout.keys)
    if not layout.split:
        return df.groupBy(*keys).agg(
            *[F.percentile(column, F.lit(float(q))).alias(name) for name, (column, q) in wanted.items()]
        )
    values = df.select(*keys, *[F.col(c).cast("double").alias(n) for n, (c, _) in wanted.items()])
    ends = _ranks(values, keys, wanted)
    place = (F.col("n") - 1).cast("double") * F.col("q")
    met = ends.groupBy(*keys, "name", "q", "n").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    between = F.col("a") + (place - F.floor(place)) * (F.col("b") - F.col("a"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between)
    return met.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n in wanted])


def _ranks(values: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """(keys, name, q, n, rank, value): the values at the two ranks around each quantile; NULL for a group without values."""
    groups = values.groupBy(*keys).agg(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(float(q)).alias("q"), F.count(name).alias("n"),
            F.min(name).alias("lo"), F.max(name).alias("hi"),
        ).alias(name)
        for name, (_, q) in wanted.items()
    ])
    place = (F.col("n") - 1).cast("double") * F.col("q")
    asked = groups.select(*keys, F.inline(F.array(*map(F.col, wanted)))).withColumn(
        "rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place))))
    )
    asked = stage(asked.withColumn("below", F.lit(0).cast("bigint")), "ranks")
    settled = asked.where("lo = hi or n = 0")
    asked = asked.where("lo < hi")
    rows = values.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in wanted])))
    while not asked.isEmpty():
        inside = join_on(rows, asked, [*keys, "name"]).where("value between lo and hi").withColumn("bin", _bin())
        bins = inside.groupBy(*keys, "name", "q", "n", "rank", "below", "bin").agg(
            F.count(F.lit(1)).alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        # at most BINS rows for each rank of a group
        run = Window.partitionBy(*keys, "name", "q", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        upto = bins.withColumn("upto", F.col("below") + F.sum("rows").over(run))
        chosen = upto.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("rows") <= F.col("rank")))
        found = stage(
            chosen.select(*keys, "name", "q", "n", "lo", "hi", "rank", (F.col("upto") - F.col("rows")).alias("below")), "ranks"
        )
        settled = settled.unionByName(found.where("lo = hi"))
        asked = found.where("lo < hi")
        if not asked.isEmpty():
            spans = asked.groupBy(*keys, "name").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
            left = join_on(rows, spans, [*keys, "name"])
            rows = stage(left.where("exists(spans, s -> value between s.lo and s.hi)").drop("spans"), "candidates")
    return settled.select(*keys, "name", "q", "n", "rank", F.col("lo").alias("value"))


def _bin() -> Column:
    """The bin of a value: growing with it, the first for ``lo`` alone of the ends and the last for ``hi``, so each round narrows the span."""
    share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    inner = F.when(share.isNull() | F.isnan(share), F.lit(1)).otherwise(F.floor(share * BINS))
    return (
        F.when(F.col("value") == F.col("lo"), F.lit(0)).when(F.col("value") == F.col("hi"), F.lit(BINS - 1))
        .otherwise(F.greatest(F.lit(0), F.least(inner, F.lit(BINS - 1)))).cast("int")
    )
