"""Language identification: held-out accuracy, sparsity, calibration and the edges of the input."""

from __future__ import annotations

import random

import numpy as np
import pytest

from perfwatch.llm import language_id as li

SYLLABLES = {"xx": ["ba", "de", "ki"], "yy": ["zu", "öm", "ra"], "zz": ["qi", "ño", "te"]}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, True, 3) for r in rows], "doc_id long, text string, lang string, score double, held_out boolean, feature int")


def test_accuracy_on_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 30 and (got.lang_pred == got.lang).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_training_never_sees_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, "xx" if i % 2 else "yy"), "xx" if i % 2 else "yy") for i in range(80)]
    held = {r.doc_id for r in frame(spark, rows).filter(li.held_out()).collect()}
    assert 5 < len(held) < 40
    spoiled = [(i, t, "zz" if i in held else lang) for i, t, lang in rows]
    a, b = ({(r.doc_id, r.lang_pred, round(r.score, 9)) for r in li.identify(frame(spark, x)).collect()} for x in (rows, spoiled))
    assert a == b and {x[1] for x in a} == {"xx", "yy"}


def test_nulls_empty_no_letters_repeats_and_long_texts(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, k), k) for i, k in enumerate("xx yy zz".split() * 20)]
    rows += [(100, None, "xx"), (101, "", "xx"), (102, "123 !? 45", "xx"), (103, text(rng, "yy"), None), (None, text(rng, "zz"), "zz"), (104, text(rng, "xx", 60_000), "xx"), (5, rows[5][1], rows[5][2])]
    got = li.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103].lang_pred == "yy" and by[None].lang_pred == "zz" and by[104].lang_pred == "xx"
    kept = li.identified(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.count() == len(rows) - 3


def test_nothing_to_learn(spark):
    assert li.identify(frame(spark, [])).collect() == []
    (r,) = li.identify(frame(spark, [(1, "abc", None)])).collect()
    assert (r.lang_pred, r.score) == ("und", 0.0)
    assert li.identified(frame(spark, [])).collect() == []


def test_elastic_net_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        y = i % 2
        at = np.unique(np.append(rng.integers(100, 4000, 30), [y, 2 + y]))
        rows.append((at, np.full(len(at), len(at) ** -0.5), y))
    loose, _ = li.ftrl(rows, 2, l1=0.0)
    sparse, bias = li.ftrl(rows, 2, l1=0.5)
    assert (sparse != 0).sum() < 0.2 * (loose != 0).sum()
    assert all((x @ sparse[at] + bias).argmax() == y for at, x, y in rows)


def test_temperature_recovers_the_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 2, (20000, 3))
    truth = np.array([rng.choice(3, p=p) for p in li._softmax(logits)])
    assert li.temperature(3 * logits, truth) == pytest.approx(3, rel=0.1)


def test_letters_of_all_planes():
    for letter in ("\U00030000", "\U00031350", "a", "é", "中"):
        assert letter.isalpha() and li.grams(letter) is not None
    for other in ("", "12 .", "\U0010ffff", "\U000e0001"):
        assert li.grams(other) is None
