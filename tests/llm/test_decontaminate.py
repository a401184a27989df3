"""Leaks against brute force; the bounds of the index lose no passage."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from perfwatch.llm import decontaminate as dc
from perfwatch.llm import text as tx


def prose(rng, n):
    words = [rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(2000)}" for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.08 else "") for w in words)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", 0.5, "q") for i, t in docs], "doc_id long, text string, item_id string, score double, answer string"),
        spark.createDataFrame([(i, t, "d") for i, t in items], "item_id long, text string, doc_id string"),
    )


def test_search_equals_scoring_every_passage():
    rng = random.Random(3)
    items = [(i, *dc.split_item(prose(rng, rng.choice([6, 20, 50, 150, 400])))) for i in range(60)]
    docs = [prose(rng, rng.choice([0, 5, 100, 700])) for _ in range(60)]
    for d in range(0, 60, 3):
        _, q, a = items[rng.randrange(60)]
        docs[d] += " " + " ".join(w for w in f"{q} {a or ''}".split() if rng.random() < 0.9)

    class Rows:
        columns = ["item_id", "question", "answer"]

        def select(self, *_):
            return self

        orderBy = select

        def toLocalIterator(self):
            return iter(items)

    (shard,) = dc.index(Rows())
    _, _, data, offsets = next(tx.slices(pa.array([d.lower() for d in docs], pa.large_string()), 1 << 60))
    words = tx.Words(data, offsets, tx.ALNUM)
    got = {(int(d), int(i)): s for d, i, s in zip(*dc.search(words, shard), strict=True)}
    impact = {(t, p): s for t in range(len(shard.terms)) for p, s in zip(
        shard.posting_item[shard.start[t] : shard.start[t + 1]], shard.impact[shard.start[t] : shard.start[t + 1]], strict=True)}
    postings = {}
    for (t, p), s in impact.items():
        postings.setdefault(t, []).append((p, s))
    want = {}
    half = dc.PASSAGE // 2
    for d in range(len(docs)):
        h = shard.find(words.hashes[words.first[d] : words.first[d] + words.counts[d]])
        for start in range(0, max(1, len(h)), half):
            score = {}
            for t in np.unique(h[start : start + dc.PASSAGE]):
                for p, s in postings.get(int(t), []) if t >= 0 else []:
                    score[p] = score.get(p, 0) + s
            for p, s in score.items():
                if s >= dc.RETRIEVE:
                    key = (d, int(shard.item_of[p]))
                    want[key] = max(want.get(key, 0), s)
    assert set(got) == set(want) and len(want) > 10
    assert all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_every_planted_item_is_found_and_clean_documents_are_not(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in dc.leaks(docs, items).collect()}

    def plain(t):
        return " ".join(re.findall(r"[^\W_]+", (t or "").lower()))

    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if f" {plain(i.text)} " in f" {plain(d.text)} "}
    assert want and got == want


def test_long_items_and_shards(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, prose(rng, 40 if i else 600)) for i in range(9)]
    docs = [(i, prose(rng, 300)) for i in range(20)] + [(100 + i, prose(rng, 150) + " " + t + " " + prose(rng, 150)) for i, t in items]
    d, b = frames(spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(d, b).collect()} == {(100 + i, i) for i in range(9)}
    monkeypatch.setattr(dc.index, "__defaults__", (4,))
    assert {(r.doc_id, r.item_id) for r in dc.leaks(d, b).collect()} == {(100 + i, i) for i in range(9)}
    assert sorted(r.doc_id for r in dc.decontaminated(d, b).collect()) == list(range(20))


def test_question_and_answer_columns(spark):
    rng = random.Random(4)
    q, a, other = prose(rng, 30), prose(rng, 12), prose(rng, 12)
    items = spark.createDataFrame([(1, q, a), (2, q, None)], "item_id long, question string, answer string")
    docs, _ = frames(spark, [(1, f"{q} {a}"), (2, f"{q} {other}"), (3, other)], [])
    got = {(r.doc_id, r.item_id): r.answer_share for r in dc.leaks(docs, items).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 2)} and got[1, 1] == 1 and got[1, 2] is None


def test_nulls_empty_and_repeated_rows(spark):
    rng = random.Random(2)
    text = prose(rng, 40)
    d, b = frames(spark, [(1, None), (2, ""), (3, text), (3, text), (None, text)], [(7, text), (8, None), (None, text), (9, "...")])
    got = sorted(((r.doc_id, r.item_id) for r in dc.leaks(d, b).collect()), key=repr)
    assert got == sorted([(3, 7), (3, 7), (None, 7), (3, None), (3, None), (None, None)], key=repr)
    assert [r.doc_id for r in dc.decontaminated(d, b).collect()] == [1, 2]
    nothing, none = frames(spark, [], [])
    assert dc.leaks(nothing, b).collect() == [] and dc.leaks(d, none).collect() == []
    assert dc.decontaminated(d, none).count() == 5 and dc.decontaminated(nothing, b).columns == d.columns


def test_short_answers_and_questions(spark):
    rng = random.Random(6)
    q, a = prose(rng, 30), prose(rng, 12)
    items = spark.createDataFrame(
        [(1, q, "Paris"), (2, "Name it", a), (3, "Capital of France?", "Paris"), (4, "Is it", "so")], "item_id long, question string, answer string"
    )
    docs, _ = frames(spark, [
        (1, f"{prose(rng, 300)} {q} paris. {prose(rng, 300)}"), (2, f"Q: {q} A: Paris"), (3, f"{q} London {prose(rng, 200)} Paris"),
        (4, f"{q} Par is"), (5, f"{prose(rng, 90)} name it: {a}"), (6, f"Name {a} it"), (7, "Q: Capital of France? A: Paris"),
        (8, f"Capital of France {prose(rng, 40)} Paris"), (9, "is it so"), (10, "Paris"), (11, None),
    ], [])
    got = {(r.doc_id, r.item_id) for r in dc.leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (5, 2), (7, 3)}
    assert sorted(r.doc_id for r in dc.decontaminated(docs, items).collect()) == [3, 4, 6, 8, 9, 10, 11]


def test_a_formula_as_last_sentence(spark):
    rng = random.Random(7)
    text = prose(rng, 30).replace(".", "") + ". x + y = 3"
    docs, items = frames(spark, [(1, f"{prose(rng, 100)} {text}"), (2, prose(rng, 100))], [(5, text)])
    assert [(r.doc_id, r.item_id) for r in dc.leaks(docs, items).collect()] == [(1, 5)]
