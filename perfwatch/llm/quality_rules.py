"""Quality rules whose cutoffs carry a guarantee. DataFrame functions only.

Each rule rejects a text whose feature exceeds a cutoff. Labelled good
documents are the holdout. For every stratum (language), rule and cutoff of a
fixed grid, the exact binomial test asks whether the share of good documents
that the rule would reject may be as large as ``ALPHA / rules``. Cutoffs are
tested from the loosest to the strictest and a rule stops at the first one
that fails (fixed sequence); strata and rules share the error ``DELTA`` by
Bonferroni. So with probability 1 - DELTA no stratum loses more than ALPHA of
its good documents. Of the safe cutoffs the one that rejects most bad less
good documents is used, the loosest among equals. A stratum with too few
labels gets no cutoff, and only the base rules hold there.

Features are made once for each document, inside generated code and array
functions; only their numbers are stored and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.session import stage

ALPHA, DELTA = 0.02, 0.05
SPACE = r"[\x20\x09-\x0D]"
NONE = "none"
_SHARES = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]
#: Rule name: feature over the counts, and its cutoffs from loose to strict.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", _SHARES),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", _SHARES),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", _SHARES),
    "capitals": ("n_capitals / greatest(word_chars, 1)", _SHARES),
    "long_words": ("word_chars / greatest(n_words, 1)", [30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0]),
}


def words(text: str = "text") -> Column:
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"\A{SPACE}+|{SPACE}+\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the counts of every text: words, code points in words, symbols, capitals, lines, repeats.

    A repeat is a word in a run of three words that the text holds twice or
    more. Runs are compared by 64-bit hashes within a text; only texts with an
    equal pair are sorted. The starts of repeated runs, in order, cover
    min(3, distance) words each.
    """
    t = F.coalesce("text", F.lit(""))
    rows = docs.select(*keep, t.alias("_t"), words().alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    rows = rows.select(
        *keep, "_w", F.size("_w").alias("_n"), lines.alias("_lines"),
        F.length(F.regexp_replace("_t", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[A-Z]+", ""))).cast("long").alias("n_capitals"),
    )
    rows = rows.select(
        *keep, "_n", "word_chars", "n_symbols", "n_capitals", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("if(_n >= 3, transform(sequence(0, _n - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])), array())").alias("_runs"),
    )
    some = "size(array_distinct(_runs)) < size(_runs)"
    rows = rows.withColumn("_sorted", F.expr(f"if({some}, sort_array(transform(_runs, (h, i) -> struct(h, i))), array())")).drop("_runs")
    same = "x.h = _sorted[greatest(j - 1, 0)].h AND j > 0 OR x.h = _sorted[least(j + 1, size(_sorted) - 1)].h AND j < size(_sorted) - 1"
    rows = rows.withColumn("_starts", F.expr(f"sort_array(filter(_sorted, (x, j) -> {same}).i)")).drop("_sorted")
    covered = "aggregate(_starts, struct(-3 AS p, 0 AS n), (a, p) -> struct(p, a.n + least(3, p - a.p)), a -> a.n)"
    return rows.select(
        *keep, F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.expr(covered).cast("long").alias("n_repeat_words"), "n_lines", "n_capitals",
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of a binomial variable, exactly, for k below its mean; 1 at and above the mean.

    Terms are summed by their logarithms, so large n do not underflow. Takes k steps.
    """
    odds = F.log(F.lit(p / (1 - p)))
    start = (n * F.log1p(F.lit(-p))).cast("double")

    def add(a: Column, j: Column) -> Column:
        term = a["t"] + F.log((n - j + 1) / j) + odds
        high, low = F.greatest(a["s"], term), F.least(a["s"], term)
        return F.struct(term.alias("t"), (high + F.log1p(F.exp(low - high))).alias("s"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    summed = F.aggregate(steps, F.struct(start.alias("t"), start.alias("s")), add, lambda a: F.exp(a["s"]))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(summed)


def cutoffs(scored: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) selected on labelled rows with a stratum, ``good`` and the features."""
    # The level is the first cutoff of the grid that the feature exceeds: it fails this one and all stricter.
    each = [
        F.struct(F.lit(r).alias("rule"), sum((F.when(F.expr(f) > c, 0).otherwise(1) for c in grid), F.lit(0)).alias("level"))
        for r, (f, grid) in RULES.items()
    ]
    levels = (
        scored.select("stratum", "good", F.inline(F.array(*each))).groupBy("stratum", "rule", "level")
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    )
    totals = levels.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
    tests = totals.groupBy().agg(F.countDistinct("stratum").alias("strata")).first().strata * len(RULES)
    grids = F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*[F.array(*map(F.lit, g)) for _, g in RULES.values()]))
    grid = totals.select("stratum", "rule", "n", F.posexplode(grids[F.col("rule")]).alias("level", "cutoff"))
    up_to = Window.partitionBy("stratum", "rule").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    known = grid.join(levels, ["stratum", "rule", "level"], "left").fillna(0, ["good", "bad"])
    known = known.withColumns({"k": F.sum("good").over(up_to), "caught": F.sum("bad").over(up_to)})
    p = binomial_tail(F.col("n"), F.col("k"), alpha / len(RULES))
    safe = known.withColumn("p", p).withColumn("worst", F.max("p").over(up_to)).filter(F.col("worst") <= delta / max(1, tests))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc(F.col("caught") - F.col("k")), "level")
    return safe.withColumn("place", F.row_number().over(best)).filter("place = 1").select("stratum", "rule", "cutoff")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts, base_failed and kept of every document (columns doc_id, text, lang; labels: doc_id, quality).

    One row per row. Null texts have no words and fail the base rule. Null
    languages are a stratum of their own. A document with several labels
    counts as good only if all are 1; labels that are null or of unknown
    documents count for nothing. Without labels only the base rules hold.
    Repeated rows get equal results; other columns are ignored.
    """
    rows = stage(
        counts(docs.select("doc_id", F.coalesce("lang", F.lit(NONE)).alias("stratum"), "text"), "doc_id", "stratum")
        .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)),
        "counts",
    )
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    chosen = stage(cutoffs(rows.filter("NOT base_failed").join(known, "doc_id"), alpha, delta), "cutoffs")
    wide = chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in RULES])
    passed = ~F.col("base_failed")
    for r, (feature, _) in RULES.items():
        passed = passed & F.coalesce(F.expr(feature) <= F.col(f"_{r}"), F.lit(True))
    return rows.join(wide, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", passed.alias("kept"),
    )
