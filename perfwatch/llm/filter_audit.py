"""Interaction audit of document filters by Lehmer-rank difference arrays.

Each document has a mask of the filters that it fails. The orders of the
filters, sorted lexicographically, have ranks; all orders that begin with the
same filters are consecutive. A mask is removed at step ``s`` exactly by the
orders that begin with ``s - 1`` filters it passes and one it fails, so each
mask removes on a few intervals of ranks. Counts of masks are added at the
ends of their intervals and a prefix sum over the ranks gives the removals of
every order at once: documents are read once, and what follows has as many
rows as parts of the corpus times masks.

Texts equal to an earlier one are found by their digest. Rows are counted by
digest and kind before they meet, so a text that fills a third of the table is
a handful of rows. No text is shuffled.
"""

from __future__ import annotations

import re
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_STRIDE = 1 << 20


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words); a long text is cut at white space, a stretch at a time."""
    seen: set[bytes] = set()
    total = at = 0
    while at < len(text):
        end = at + _STRIDE
        space = _SPACE.search(text, end) if end < len(text) else None
        end = space.start() if space else len(text)
        words = text[at:end].split()  # splits bytes at the six ASCII white-space characters
        total += len(words)
        seen.update(words)
        at = end
    return total, len(seen)


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: the text fails filter A, B, C, D."""
    words, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    fails = (
        words < LEAST_WORDS,
        100 * distinct < DISTINCT_PERCENT * words,
        100 * capitals > CAPITAL_PERCENT * points,
        len(text) != len(text.translate(None, _SYMBOLS)),
    )
    return sum(bit << i for i, bit in enumerate(fails))


def _masks(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        masks = pa.array((mask_of(x.as_py()) for x in texts), pa.int32())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "key")), masks], names=["doc_id", "part", "key", "mask"])


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of ``docs`` by source and failed filters, and how many are labelled so."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("part", T.StringType()),
        T.StructField("key", T.BinaryType()), T.StructField("mask", T.IntegerType()),
    ])
    judged = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    kind = ["key", "part", "mask", "good", "toxic"]
    known = (
        rows.mapInArrow(_masks, schema).join(judged, "doc_id", "left")
        .groupBy("doc_id", "key", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
        .agg(F.count("*").alias("n"))
    )
    # Of one text and kind only the smallest id can be the first one; a row without id is nobody's copy.
    kinds = known.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    lowest = F.min("first.doc_id").over(Window.partitionBy("key"))
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    split = kinds.withColumn("lowest", lowest).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), passing.alias("n")),
            F.struct((F.col("mask") + (1 << (len(LETTERS) - 1))).alias("mask"), (F.col("n") - passing).alias("n")),
        )),
    )
    return split.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def intervals(filters: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, lo, hi): orders of rank lo to hi - 1 remove the mask at that step. Depends on the number of filters alone."""
    found = []
    for mask in range(1, 1 << filters):
        passes = [f for f in range(filters) if not mask >> f & 1]
        fails = [f for f in range(filters) if mask >> f & 1]
        for length in range(len(passes) + 1):
            for before in permutations(passes, length):
                for f in fails:
                    rank = 0
                    left = list(range(filters))
                    for at, x in enumerate((*before, f)):
                        rank += left.index(x) * factorial(filters - 1 - at)
                        left.remove(x)
                    found.append((mask, length + 1, rank, rank + factorial(filters - 1 - length)))
    return found


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Removals of every order of the filters, from counts by mask.

    ``counts`` has part, mask (bit i: fails ``letters[i]``), n, good, toxic, a
    row for each part and mask. The result has, for each part, order and step:
    part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. Letters must be in ascending order. No
    counts give an empty result.
    """
    size = len(letters)
    orders = ["".join(x) for x in permutations(letters)]
    covered = counts.sparkSession.createDataFrame(intervals(size), "mask int, step int, lo int, hi int")
    values = ("n", "good", "toxic")
    ends = counts.join(F.broadcast(covered), "mask").select(
        "part", "step", F.inline(F.array(*(
            F.struct(F.col(end).alias("rank"), *((sign * F.col(c)).alias(c) for c in values)) for end, sign in (("lo", 1), ("hi", -1))
        ))),
    )
    grid = (
        counts.select("part").distinct()
        .select("part", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
        .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"), *(F.lit(0).cast("long").alias(c) for c in values))
    )
    changes = ends.unionByName(grid).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in values))
    so_far = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = (
        changes.select("part", "step", "rank", *(F.sum(c).over(so_far).alias(c) for c in values)).filter(F.col("rank") < len(orders))
        .withColumn("filter_order", F.element_at(F.lit(orders), F.col("rank") + 1))
        .withColumn("filter", F.instr(F.lit(letters), F.col("filter_order").substr(F.col("step"), F.lit(1))))
    )
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(size)]
    alone = [F.sum(F.when(F.col("mask") == (1 << i), F.col("n")).otherwise(0)) for i in range(size)]
    whole = counts.groupBy("part").agg(F.sum("n").alias("whole"), F.array(*failing).alias("failing"), F.array(*alone).alias("alone"))
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return removed.join(whole, "part").select(
        "part", "filter_order", "step",
        (F.col("whole") - F.sum("n").over(steps)).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("failing", F.col("filter")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("filter")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``docs`` (doc_id, text, source), in all orders; see ``interactions``.

    A document fails A with under 200 words, B if under half of its words are
    distinct, C if over 2% of its characters are A-Z, D if it has one of
    ``#$%&*|``, E if a smaller doc_id has the same text. A null text is empty,
    a null source the empty string. Repeated rows count as documents, and rows
    of the same doc_id are not copies of each other. A null doc_id is no copy
    and makes none. Several labels of a document count if one says so; null
    labels say nothing. An empty table gives an empty result; other columns
    are ignored.
    """
    return interactions(mask_counts(docs, labels))
