"""License scans by diagonal voting.

All rolling pairs of words of every text are hashed and joined with the
positions of the same pairs in license templates. A hit at text position p and
template position q votes for the diagonal p - q: a copied passage puts its
votes on one diagonal, or on neighbouring ones where words were added or lost.
Diagonals are clustered by offset, so that a distant one never stands between two
neighbours; those of a cluster that follow each other in the text are merged, and
a merged span is accepted if it covers enough of the template. Hash hits count only where both words are equal.

The templates are a parameter of bounded size (``MOST_WORDS`` words, checked),
so they are broadcast and the texts are not shuffled; only hits are, and they
are spread by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_WORDS = 100_000
COVERED, GAP, DRIFT = 0.6, 8, 4
#: Templates of up to this many words must be there whole.
SHORT = 12

#: Phrases that are licenses wherever their words stand together.
PHRASES = {"cc-by": ["cc by"], "gpl": ["general public license"], "reserved": ["all rights reserved"]}
#: Notices of common licenses, lower-case words.
NOTICES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied see the license for the specific language governing permissions and limitations under the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
    "gpl-3.0": ["licensed under the gnu general public license version 3"],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so",
    ],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}


def words(text: str = "text") -> Column:
    """Runs of digits, ASCII letters in lower case, and non-ASCII characters.

    Two non-ASCII letters whose lower case is ASCII are set aside first, so only A-Z change into ASCII.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    for odd in ("\u212a", "\u0130"):
        t = F.replace(t, F.lit(odd), F.lit("\ue000"))
    return F.filter(F.split(F.lower(t), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _templates(spark, notices: dict[str, list[str]], phrases: dict[str, list[str]]) -> DataFrame:
    """A row for each pair of neighbouring words of each template."""
    rows, total, number = [], 0, 0
    for exact, table in ((True, phrases), (False, notices)):
        for label, texts in table.items():
            for text in texts:
                w = text.split()
                total += len(w)
                if len(w) < 2:
                    raise ValueError(f"A template needs two words: {text!r}")
                rows += [(number, label, exact, len(w), q, w[q], w[q + 1]) for q in range(len(w) - 1)]
                number += 1
    if total > MOST_WORDS:
        raise ValueError(f"Templates of {total} words; at most {MOST_WORDS} are broadcast.")
    frame = spark.createDataFrame(rows, "template int, label string, exact boolean, length int, q int, w1 string, w2 string")
    return frame.withColumn("h", F.xxhash64("w1", "w2"))


def spans(docs: DataFrame, notices: dict[str, list[str]] | None = None, phrases: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, text_hash, label, exact, first_word, last_word, covered) of every accepted span.

    ``exact`` spans are places where the words of a phrase stand consecutively
    (last_word is the last word of the span). Rows are keyed by doc_id and a
    hash of the text: repeated rows have one set of spans.
    """
    templates = _templates(docs.sparkSession, NOTICES if notices is None else notices, PHRASES if phrases is None else phrases)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words().alias("w"))
    pairs = F.expr("if(size(w) > 1, transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1])), array())")
    grams = rows.select("doc_id", "text_hash", "w", F.posexplode(pairs).alias("p", "h"))
    hits = (
        grams.join(F.broadcast(templates), "h").filter("w[p] = w1 AND w[p + 1] = w2")
        .select("doc_id", "text_hash", "template", "label", "exact", "length", "p", "q").distinct()
    )
    keys = ["doc_id", "text_hash", "template", "label", "exact", "length"]
    diagonals = hits.groupBy(*keys, (F.col("p") - F.col("q")).alias("d")).agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.count("*").alias("votes"), F.collect_set("q").alias("at")
    )
    places = diagonals.filter("exact AND votes = length - 1")
    of = ["doc_id", "text_hash", "template"]
    offsets = Window.partitionBy(*of).orderBy("d")
    drifted = F.when(F.col("d") - F.lag("d").over(offsets) <= DRIFT, 0).otherwise(1)
    clustered = (
        diagonals.filter("NOT exact AND (votes > 1 OR length < 4)").withColumn("drifted", drifted)
        .withColumn("cluster", F.sum("drifted").over(offsets.rowsBetween(Window.unboundedPreceding, 0)))
    )
    runs = Window.partitionBy(*of, "cluster").orderBy("lo", "d")
    before = F.max("hi").over(runs.rowsBetween(Window.unboundedPreceding, -1))
    marked = clustered.withColumn("new", F.when(F.col("lo") - before <= GAP, 0).otherwise(1))
    merged = (
        marked.withColumn("run", F.sum("new").over(runs.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "cluster", "run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"))
    )
    columns = ["doc_id", "text_hash", "label", "exact", F.col("lo").alias("first_word"), (F.col("hi") + 1).alias("last_word")]
    share = (F.col("votes") / (F.col("length") - 1)).alias("covered")
    enough = F.when(F.col("length") <= SHORT, 1.0).otherwise(COVERED)
    return places.select(*columns, share).union(merged.filter(share >= enough).select(*columns, share))


def scan(docs: DataFrame, **settings) -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    One row per row (columns doc_id, text). n_base counts the places of
    phrases, first_word and last_word are their smallest and largest start
    (null without one). score is the largest covered share of a template, 0
    without a span. Null and empty texts have no words; repeated rows get
    equal results; other columns are ignored.
    """
    found = spans(docs, **settings).groupBy("doc_id", "text_hash").agg(
        F.sum(F.col("exact").cast("long")).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("covered").alias("score"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words()).cast("long").alias("n_words"))
    match = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.text_hash") == F.col("f.text_hash"))
    return rows.alias("r").join(found.alias("f"), match, "left").select(
        "r.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
