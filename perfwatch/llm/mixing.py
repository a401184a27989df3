"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only.

*Raking.* Tokens are summed into cells of (source, language, topic). Each
sweep scales the cells to the target total of every source, then of every
language, then of every topic, until all marginals are within ``TOLERANCE``.
A cell ends as its tokens times one factor for each of its three values.

*Sampling.* A document is kept with a probability proportional to the factor
of its cell, decided by a hash of its id and text, so a rerun keeps the same
rows. Cells that would need documents twice are kept whole (probability 1), and
one scale for all others makes up the budget. The budget is ``share`` of all
tokens, or else the largest one at which kept-whole cells lack at most ``SHORT`` of
the mixture: that is as far as it can be from the targets in expectation, and
a rare cell with a large factor has no say over all others.

Default targets flatten each observed marginal (its share to the power
``FLATTEN``), as is usual for mixtures. Sums are map-side aggregates and only
cells, never documents, are shuffled; hot sources are one row per language and
topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.session import stage

DIMENSIONS = ("source", "lang", "topic")
FLATTEN = 0.7
TOLERANCE = 1e-3
#: The share of the mixture that may be lacking in cells that are kept whole.
SHORT = 0.01
SWEEPS = 30
CELLS_PER_TASK = 200_000
NONE = "none"
WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: str = "text") -> Column:
    """Words between ASCII white space."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def topic(text: str = "text") -> Column:
    """The form of a text as its topic where the table has no topic column: table, code, notes, article or book."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t)
    bars = n - F.length(F.replace(t, F.lit("|"), F.lit("")))
    signs = n - F.length(F.translate(t, "#*$%&<>{};=", ""))
    return (
        F.when(bars * 25 > n, "table").when(signs * 12 > n, "code").when(n < 500, "notes").when(n < 5000, "article").otherwise("book")
    )


def _cells(docs: DataFrame) -> DataFrame:
    known = F.col("topic") if "topic" in docs.columns else topic()
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.coalesce("source", F.lit(NONE)).alias("source"),
        F.coalesce("lang", F.lit(NONE)).alias("lang"), F.coalesce(known, F.lit(NONE)).alias("topic"), tokens().alias("tokens"),
    )


def _targets(cells: DataFrame, dimension: str, given: dict[str, float] | None, flatten: float) -> DataFrame:
    """(value, target): shares of one dimension that add up to 1."""
    if given is not None:
        total = sum(given.values())
        pairs = [F.struct(F.lit(k).alias(dimension), F.lit(v / total).alias("target")) for k, v in given.items() if v > 0]
        return cells.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("base"), flatten).alias("target"))
    total = sums.agg(F.sum("target")).first()[0] or 1.0
    return sums.select(dimension, (F.col("target") / total).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (source, lang, topic, base) with ``weight``, raked to the targets; weights add up to 1.

    Values that have no target, and targets of values that have no cell, are
    left out. Stops when no marginal had to be scaled by more than
    ``tolerance`` in a sweep, else after ``sweeps`` sweeps (targets that
    contradict each other never fit). Few cells are swept in one task, as
    shuffling them would cost more than scaling them; the rows are the same.
    """
    parts = -(-cells.count() // CELLS_PER_TASK)

    def gathered(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if parts <= 1 else df

    fitted = gathered(cells).withColumn("weight", F.col("base").cast("double"))
    for dimension, target in targets.items():
        fitted = fitted.join(gathered(target).select(dimension, F.col("target").alias(f"t_{dimension}")), dimension)
    fitted = stage(gathered(fitted), "cells")
    names = [c for c in fitted.columns if c != "weight"]
    for _ in range(sweeps):
        fitted = gathered(fitted).withColumn("off", F.lit(0.0))
        for dimension in targets:
            sums = fitted.groupBy(dimension).agg(F.sum("weight").alias("sum"))
            factor = F.col(f"t_{dimension}") / F.col("sum")
            off = F.greatest(F.col("off"), F.abs(factor - 1)).alias("off")
            fitted = fitted.join(sums, dimension).select(*names, (F.col("weight") * factor).alias("weight"), off)
        fitted = stage(fitted, "cells")
        if (fitted.agg(F.max("off")).first()[0] or 0) < tolerance:
            break
        fitted = fitted.drop("off")
    return fitted.drop("off")


def _scale(rated: DataFrame, share: float | None, short: float = SHORT) -> float:
    """The scale s of ``rated`` (base, weight): a cell keeps least(base, s * weight) tokens.

    With ``share``, they add up to that share of all tokens, or as near as
    targets reach. Otherwise s is the largest scale at which they add up to
    (1 - short) * s at least. Both sums are concave in s, so Newton steps come
    from one side and end at the exact scale after a few aggregates.
    """
    whole, total = rated.agg(F.sum("base"), F.sum("weight")).first()
    if not total:
        return 0.0
    budget = None if share is None else min(1.0, share) * float(whole)
    scale = float(whole) / (1 - short) / total if budget is None else 0.0
    while True:
        clipped = F.col("base") <= F.col("weight") * scale
        kept, open_weight = rated.agg(F.sum(F.when(clipped, F.col("base")).otherwise(0)), F.sum(F.when(clipped, 0.0).otherwise(F.col("weight")))).first()
        if budget is not None:
            following = (budget - kept) / open_weight if open_weight else scale
            if following <= scale * (1 + 1e-9):
                return scale
        else:
            following = kept / ((1 - short) * total - open_weight) if kept else scale
            if following >= scale * (1 - 1e-9):
                return scale
        scale = following


def mixture(
    docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, share: float | None = None,
    flatten: float = FLATTEN, seed: int = 1,
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, kept of every document.

    One row per row (columns doc_id, text, source, lang, and topic if there is
    one). ``targets`` maps source, lang and topic to shares; a dimension that
    is not given is flattened. Null values count as ``none``. Documents without
    a word have no weight to sample by: probability 0, kept false. ``weight``
    is the share of the mixture that the document stands for. Repeated rows
    are kept or left together; values without a target get probability 0; an
    empty table gives an empty result.
    """
    given = targets or {}
    rows = stage(_cells(docs), "tokens")
    cells = stage(rows.filter("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("base")), "base")
    fitted = rake(cells, {d: _targets(cells, d, given.get(d), flatten) for d in DIMENSIONS})
    scale = _scale(fitted, share)
    factors = fitted.select(*DIMENSIONS, (F.col("weight") / F.col("base")).alias("factor"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(seed)), 11) * F.lit(2.0**-53)
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.coalesce("factor", F.lit(0.0)) * scale)).otherwise(F.lit(0.0))
    return rows.join(factors, [*DIMENSIONS], "left").select(
        "doc_id", "text_hash", *DIMENSIONS, "tokens", (F.col("tokens") * F.coalesce("factor", F.lit(0.0))).alias("weight"),
        probability.alias("probability"), (u < probability).alias("kept"),
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The sampled rows of ``docs``, unchanged. Rows are told apart by doc_id and text."""
    kept = mixture(docs, **settings).filter("kept").select("doc_id", "text_hash").distinct()
    match = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("k.text_hash"))
    return docs.alias("d").join(kept.alias("k"), match, "left_semi")
