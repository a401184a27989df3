"""Held-out accuracy, shrinkage and calibration of the quality classifier, and the edges of the input."""

from __future__ import annotations

import random

import numpy as np
import pytest

from perfwatch.llm import quality_model as qm


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], "doc_id long, text string, source string, lang string, host string, good int, prior double")


def labels(spark, rows):
    return spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, quality int, toxic int, source string")


def corpus(seed, n=1500, rates=None):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        host = "hot" if rng.random() < 0.4 else f"h{rng.randrange(30)}"
        good = rng.random() < (rates or {}).get(host, 0.8)
        pool = ["fine", "clear", "well"] if good else ["junk", "spam", "click"]
        words = [rng.choice(pool) if rng.random() < 0.15 else f"w{rng.randrange(300)}" for _ in range(40)]
        rows.append((i, " ".join(words), host, rng.choice("ab")))
        marks.append((i, int(good)))
    return rows, marks


def test_unlabelled_documents_are_told_apart(spark):
    rows, marks = corpus(1)
    known = [m for m in marks if m[0] % 2]
    got = {r.doc_id: r for r in qm.classify(frame(spark, rows), labels(spark, known)).collect()}
    hits = [got[i].kept == bool(q) for i, q in marks if i % 2 == 0]
    assert len(got) == len(rows) and sum(hits) / len(hits) > 0.97
    assert all(0 <= r.quality <= 1 for r in got.values())


def test_the_given_documents(spark, sf):
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = qm.classify(docs, marks).join(marks.select("doc_id", "quality").toDF("doc_id", "label"), "doc_id").toPandas()
    assert (got.kept[got.label == 1]).mean() > 0.95
    assert got.quality[got.label == 1].mean() > got.quality[got.label == 0].mean() + 0.2


def test_sparse_sites_shrink_to_the_global_prior(spark):
    rng = random.Random(2)
    rates = {f"h{i}": rng.choice([0.3, 0.95]) for i in range(30)}
    rows, marks = corpus(3, 3000, rates)
    rows += [(9000, rows[0][1], "rare", "a"), (9001, rows[0][1], "unseen", "a")]
    prior = {(r.host, r.path): r.prior for r in qm.classify(frame(spark, rows), labels(spark, [*marks, (9000, 0)])).collect()}
    share = sum(q for _, q in marks) / len(marks)
    assert prior["unseen", "a"] == pytest.approx(share, abs=0.03)
    assert prior["h0", "a"] == pytest.approx(rates["h0"], abs=0.15)
    assert share > prior["rare", "a"] > 0.1


def test_strength_is_the_one_the_rates_were_drawn_with(spark):
    rng = np.random.default_rng(4)
    rows = [(f"h{i}", 50, int(rng.binomial(50, rng.beta(0.7 * 12, 0.3 * 12)))) for i in range(2000)]
    from pyspark.sql import functions as F

    assert qm._strength(spark.createDataFrame(rows, "host string, n long, good long"), F.lit(0.7)) == pytest.approx(12, rel=0.25)


def test_calibration_recovers_slope_and_shift():
    x = np.linspace(-4, 4, 200)
    p = 1 / (1 + np.exp(-(0.5 * x + 1)))
    assert qm.calibrate(x, 1000 * p, 1000 * (1 - p)) == pytest.approx((0.5, 1), abs=0.01)


def test_nulls_empty_repeats_and_missing_labels(spark):
    rows, marks = corpus(5, 300)
    odd = [(9001, None, None, None), (9002, "", "hot", "a"), (9003, "...", "hot", None), (None, "fine clear", None, "a"), (5, *rows[5][1:]), (9004, "fine " * 100_000, "hot", "a")]
    docs = frame(spark, rows + odd)
    got = qm.classify(docs, labels(spark, [*marks, (5, 0), (9001, None), (None, 1), (123456, 1)])).collect()
    assert len(got) == len(rows) + len(odd) and all(r.quality is not None and 0 <= r.quality <= 1 for r in got)
    assert len({r.quality for r in got if r.doc_id == 5}) == 1
    none = labels(spark, [])
    assert {round(r.quality, 6) for r in qm.classify(docs, none).collect()} == {0.5}
    assert qm.classify(frame(spark, []), labels(spark, marks)).collect() == []
