"""Near-duplicate classes against brute force, and the edges of the input."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from perfwatch.llm import near_duplicates as nd
from perfwatch.llm import text as tx

SCHEMA = "doc_id long, text string, key string, label long, node string, bucket int, a int, b int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 3, 4) for i, t in rows], SCHEMA)


def shingles(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(i, shingles(t)) for i, t in rows]
    for x, (i, a) in enumerate(bags):
        for j, b in bags[:x]:
            both = sum((a & b).values())
            if a and b and both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i in parent}


def words(texts):
    _, _, data, offsets = next(tx.slices(pa.array(texts, pa.large_string()), 1 << 60))
    return tx.Words(data, offsets, tx.NOT_SPACE)


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(25):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 60, 200, 500]))
        for _ in range(rng.choice([1, 2, 12, 40])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = random.Random(1)
    a = rng.choices("abcdefghijklmnopqrstuvwxyz", k=2000)
    b = list(a)
    for _ in range(120):
        b[rng.randrange(len(b))] = "zz"
    pair = words([" ".join(a), " ".join(b)])
    s = nd.signatures(pair, 2, 4000)
    doc, h, w = tx.weighted_elements(pair, 2)
    exact = nd.overlap(h[doc == 0], w[doc == 0], h[doc == 1], w[doc == 1])
    x, y = Counter(zip(a, a[1:], strict=False)), Counter(zip(b, b[1:], strict=False))
    assert exact == pytest.approx(sum((x & y).values()) / sum((x | y).values()))
    assert abs((s[0] == s[1]).mean() - exact) < 0.03


def test_darts_follow_a_poisson_law():
    u = (np.arange(100_000) + 0.5) / 100_000
    for mean in (1.0, 8.0, 256.0):
        n = nd._darts(u, mean)
        assert n.mean() == pytest.approx(mean, rel=0.01) and n.var() == pytest.approx(mean, rel=0.03)


def test_a_signature_does_not_depend_on_the_neighbours():
    texts = ["one two three four five six", "", "x", "one two three four five six seven " * 300]
    together = nd.signatures(words(texts), 5, 80)
    for i, t in enumerate(texts):
        assert (nd.signatures(words([t]), 5, 80)[0] == together[i]).all()


def test_nulls_empty_ties_repeats_and_long_texts(spark):
    long = " ".join(f"v{i % 5000}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (5, "ONE  two"), (None, "one two"), (6, long), (7, long + " end"), (None, "alone here")]
    got = nd.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.class_id, r.class_size, r.keeps))
    assert by[1] == [(1, 1, True)] and by[2] == [(2, 1, True)] and by[3] == [(3, 1, True)]
    assert by[4] == [(4, 4, True)] * 2 and by[5] == [(4, 4, False)]
    assert by[6] == [(6, 2, True)] and by[7] == [(6, 2, False)]
    assert sorted(by[None], key=repr) == sorted([(4, 4, False), (None, 1, True)], key=repr)
    kept = nd.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r.doc_id, (r.text or "")[:10]) for r in kept.filter("doc_id IS NOT NULL").collect()) == [
        (1, ""), (2, ""), (3, " \n\t"), (4, "one two"), (6, long[:10])
    ]
    assert [r.text for r in kept.filter("doc_id IS NULL").collect()] == ["alone here"]


def test_empty_table(spark):
    assert nd.near_duplicates(frame(spark, [])).collect() == []
    assert nd.one_of_each(frame(spark, [])).collect() == []


def test_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r.node: r.label for r in nd.components(links).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[i] for i in (100, 101, 102)} == {100}


def test_a_single_link_in_a_large_mixed_bucket_is_found(spark):
    core = [f"c{i}" for i in range(64)]
    rows = [(i, " ".join(core + [f"u{i}x{j}" for j in range(40)])) for i in range(1500)]
    rows += [(2000 + i, " ".join(rows[i][1].split()[:-4] + ["y"] * 4)) for i in range(700, 708)]
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(frame(spark, rows), bands=4, rows=1).collect()}
    assert got == {i: i - 2000 if i >= 2000 else i for i, _ in rows}


def test_open_pairs_hold_every_similar_pair_with_repeated_and_hot_shingles(spark, monkeypatch):
    monkeypatch.setattr(nd, "SALTED", 7)
    rng = random.Random(12)
    base = rng.choices("abcdefgh", k=60)
    bags = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(60)] = rng.choice("abcdefghxyz")
        doc, h, w = tx.weighted_elements(words([" ".join(copy)]), 2)
        bags.append((i, h, w.astype(np.int32)))
    pairs = {(i, j) for i, h, w in bags for j, g, v in bags if i < j and nd.overlap(h, w, g, v) >= 0.8}
    mixed = spark.createDataFrame([(i, int(w.sum()), i, 60, 0) for i, _, w in bags], "node long, n long, label long, size long, main long")
    sets = spark.createDataFrame([(i, bytearray(h.tobytes()), bytearray(w.tobytes())) for i, h, w in bags], "node long, h binary, w binary")
    got = {(r.a, r.b) for r in nd._open_pairs(mixed, sets, 0.8).collect()}
    assert pairs and pairs <= got


def test_a_repeated_row_gives_one_bag():
    batch = pa.RecordBatch.from_arrays([pa.array([3, 4, 3]), pa.array(["a b", "c", "a b"])], names=["node", "text"])
    out = [x for b in nd._bags(5)([batch, batch]) for x in b.column("node").to_pylist()]
    assert out == [3, 4]
