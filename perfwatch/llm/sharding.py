"""Sharding along a Hilbert curve, for files that prune on several columns.

Each document is a point: its language, source and size, each quantised to
``2**BITS`` cells by approximate quantiles, so cells hold similar numbers of
rows however skewed a column is. Rows are sorted by the index of their cell on
the Hilbert curve and the sorted run is cut into shards whose counts are at
most one apart. Neighbours on the curve are near in every dimension, so a
shard has narrow ranges in each and a reader skips most shards for a filter on
any of them.

The sort is a range partitioning; ranks come from the sizes of the partitions,
so no task sees more than its own range. Quantiles are mergeable sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.session import stage

BITS = 4
DIMENSIONS = 3
SHARDS = 8


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Position of a cell on the Hilbert curve through a cube of ``2**bits`` cells a side.

    The curve visits the halves of the cube recursively: at each level the
    Gray-code rank of the octant extends the index, and the axes are mirrored
    and exchanged so that the next level starts where the last one ended.
    """
    x, n = list(point), len(point)
    for level in reversed(range(1, bits)):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            if x[i] & bit:
                x[0] ^= below
            else:
                swap = (x[0] ^ x[i]) & below
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = 0
    for level in reversed(range(1, bits)):
        if x[n - 1] & (1 << level):
            turn ^= (1 << level) - 1
    x = [v ^ turn for v in x]
    index = 0
    for level in reversed(range(bits)):
        for v in x:
            index = index << 1 | (v >> level & 1)
    return index


def _shared_prefix(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _order_number(column: str, skip: int) -> Column:
    """A number in the order of a text column: the seven bytes after the shared prefix; null is lowest."""
    tail = F.expr(f"hex(substring(cast(`{column}` as binary), {skip + 1}, 7))")
    return F.coalesce(F.conv(F.rpad(tail, 14, "0"), 16, 10).cast("double") + 1, F.lit(0.0))


def placed(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, and ``cell``, the index on the curve, of every row."""
    rows = docs.select(
        "doc_id", "lang", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).cast("long").alias("text_crc32"),
    )
    rows = stage(rows, "sizes")
    ends = rows.agg(*[f(c).alias(f"{n}_{c}") for c in ("lang", "source") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    numbers = {
        "lang": _order_number("lang", _shared_prefix(ends.lo_lang, ends.hi_lang)),
        "source": _order_number("source", _shared_prefix(ends.lo_source, ends.hi_source)),
        "size": F.col("size").cast("double"),
    }
    side = 1 << bits
    shares = [i / side for i in range(1, side)]
    cuts = rows.agg(*[F.percentile_approx(x, shares, 10000).alias(c) for c, x in numbers.items()]).first()
    at = F.lit(0)
    for c, x in numbers.items():
        bounds = sorted(set(cuts[c] or []))
        spot = sum((F.when(x > b, 1).otherwise(0) for b in bounds), F.lit(0))
        at = at * side + spot
    curve = [
        hilbert_index((i // side**2, i // side % side, i % side), bits) for i in range(side**DIMENSIONS)
    ]
    return rows.select("doc_id", "size", "text_crc32", F.element_at(F.array(*map(F.lit, curve)), at + 1).alias("cell"))


def ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``position``, the place from 0 in the order of ``keys``.

    Rows are dealt by ranges of the keys and stored in order with their place
    in the partition; the offsets of the partitions are summed over one row
    for each partition.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    kept = stage(
        ordered.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ranges"
    )
    sizes = kept.groupBy("_part").agg(F.count("*").alias("n"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("before"))
    return kept.join(before, "_part").select(*rows.columns, (F.col("before") + F.col("_place")).alias("position"))


def shards(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and hilbert of every document.

    One row per row (columns doc_id, text, lang, source). The law is ``rows``:
    shard i holds the rows whose rank r has floor(r * n / rows) = i, so counts
    differ by at most one; slots number the rows of a shard from 0 in curve
    order. Ties on the curve are ordered by checksum, id and size, so equal
    texts of one source stand together. Null texts have size 1 and the
    checksum of an empty text; null languages and sources come first; repeated
    rows get slots of their own; an empty table gives an empty result.
    """
    rows = ranked(placed(docs), "cell", "text_crc32", "doc_id", "size")
    total = rows.count()
    r = F.col("position")
    shard = F.expr(f"position * {n} div {max(1, total)}")
    first = F.expr(f"((position * {n} div {max(1, total)}) * {total} + {n - 1}) div {n}")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        (r - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("cell").alias("hilbert"),
    )
