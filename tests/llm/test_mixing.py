"""Raked weights against numpy, the mixture against its targets, and the edges of the input."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfwatch.llm import mixing as mx


def frame(spark, rows, topic=True):
    schema = "doc_id long, text string, source string, lang string, topic string, weight double, tokens int, factor int, base int"
    df = spark.createDataFrame([(*r, 1.0, 2, 3, 4) for r in rows], schema)
    return df if topic else df.drop("topic")


def corpus(seed, n=4000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(4)}"
        out.append((i, "w " * rng.randrange(1, 60), source, rng.choice("aaab"), rng.choice(["t", "t", "u"])))
    return out


def test_weights_equal_numpy_raking(spark):
    rows = corpus(1)
    targets = {"source": {"hot": 1, "s0": 1, "s1": 1, "s2": 1, "s3": 1}, "lang": {"a": 0.5, "b": 0.5}, "topic": {"t": 0.3, "u": 0.7}}
    got = mx.mixture(frame(spark, rows), targets).groupBy("source", "lang", "topic").agg(F.sum("weight").alias("w")).collect()
    names = [sorted(t) for t in targets.values()]
    cells = np.zeros([len(n) for n in names])
    for _, text, *key in rows:
        cells[tuple(n.index(k) for n, k in zip(names, key, strict=True))] += len(text.split())
    for _ in range(200):
        for axis, (t, n) in enumerate(zip(targets.values(), names, strict=True)):
            want = np.array([t[x] for x in n]) / sum(t.values())
            others = tuple(a for a in range(3) if a != axis)
            shape = [-1 if a == axis else 1 for a in range(3)]
            cells *= (want / cells.sum(axis=others)).reshape(shape)
    for r in got:
        assert r.w == pytest.approx(cells[tuple(n.index(k) for n, k in zip(names, (r.source, r.lang, r.topic), strict=True))], rel=5e-3)


def test_kept_tokens_meet_the_targets(spark):
    got = mx.mixture(frame(spark, corpus(2, 20_000)), {"lang": {"a": 0.4, "b": 0.6}}).filter("kept").groupBy("lang").agg(F.sum("tokens").alias("n")).collect()
    n = {r.lang: r.n for r in got}
    assert n["b"] / sum(n.values()) == pytest.approx(0.6, abs=0.03)


def test_a_share_of_tokens_can_be_asked_for(spark):
    r = mx.mixture(frame(spark, corpus(3, 20_000)), share=0.25).agg(F.sum("tokens").alias("n"), F.sum(F.when(F.col("kept"), F.col("tokens"))).alias("k")).first()
    assert r.k / r.n == pytest.approx(0.25, abs=0.02)


def test_topics_come_from_the_form_without_a_column(spark):
    rows = [(1, "a | b | c | d |", None, None, None), (2, "{}=;#" * 20, None, None, None), (3, "hi", None, None, None), (4, "w " * 400, None, None, None), (5, "w " * 4000, None, None, None)]
    got = {r.doc_id: r.topic for r in mx.mixture(frame(spark, rows, topic=False)).collect()}
    assert got == {1: "table", 2: "code", 3: "notes", 4: "article", 5: "book"}


def test_nulls_empty_repeats_and_missing_targets(spark):
    rows = [(1, None, "a", "x", "t"), (2, "", None, "x", "t"), (3, " \n", "a", None, None), (4, "one two", None, None, None), (4, "one two", None, None, None), (None, "z", "a", "x", "t"), (5, "w " * 100_000, "b", "x", "t")]
    docs = frame(spark, rows)
    got = mx.mixture(docs).collect()
    assert len(got) == len(rows)
    assert all(not r.kept and r.probability == 0 for r in got if r.tokens == 0)
    assert len({(r.kept, r.probability) for r in got if r.doc_id == 4}) == 1
    assert sum(r.weight for r in got) == pytest.approx(1, abs=1e-6)
    assert max(r.probability for r in got) == pytest.approx(1)
    kept = mx.mixed(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert {r.doc_id: r.probability for r in mx.mixture(docs, {"source": {"b": 1.0, "absent": 1.0}}).filter("probability > 0").collect()} == {5: 1.0}
    none = frame(spark, [])
    assert mx.mixture(none).collect() == [] and mx.mixed(none).collect() == []


def test_a_rerun_keeps_the_same_rows(spark):
    a, b = ({r.doc_id for r in mx.mixed(frame(spark, corpus(4, 500)).repartition(n)).collect()} for n in (1, 7))
    assert a == b and 0 < len(a) < 500


def test_one_odd_document_does_not_set_the_share(spark):
    rows = corpus(5, 6000)

    def kept(rows):
        got = mx.mixture(frame(spark, rows))
        r = got.agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("probability")).alias("k")).first()
        off = sum(
            abs(x.k / r.k - x.w) for x in got.groupBy("source", "lang", "topic").agg(F.sum(F.col("tokens") * F.col("probability")).alias("k"), F.sum("weight").alias("w")).collect()
        )
        return r.k / r.n, off / 2

    plain, off = kept(rows)
    odd, odd_off = kept([*rows, (9999, "w", "odd", "a", "t")])
    assert odd > 0.95 * plain and plain > 0.5
    assert off <= mx.SHORT + 2e-3 and odd_off <= mx.SHORT + 2e-3


def test_a_budget_is_met_with_cells_kept_whole(spark):
    rows = [*corpus(6, 6000), (9999, "w " * 5, "odd", "b", "u")]
    r = mx.mixture(frame(spark, rows), share=0.6).agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("probability")).alias("k")).first()
    assert r.k / r.n == pytest.approx(0.6, abs=1e-6)


def test_other_line_ends_are_words(spark):
    texts = [f"abc {end}" for end in "\u0085\u2028\u2029"] + ["a\u2028", " a \n", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n"] for r in frame.orderBy("doc_id").select(mx.tokens().alias("n")).collect()] == [2, 2, 2, 1, 1, 0]
