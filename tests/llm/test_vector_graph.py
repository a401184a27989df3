"""Vector links against brute force over all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from perfwatch.llm import vector_graph as vg

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, key string, node long"


def brute_force(rows, similar=0.95):
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= similar:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    smallest = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            smallest[root(i)] = min(vec, smallest.get(root(i), vec))
    out = [(vec, links[i], smallest.get(root(i)), vec == smallest.get(root(i))) for i, (vec, _) in enumerate(rows)]
    return sorted(out, key=repr)


def result(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, 1, "u", "k", 5) for i, v in rows], SCHEMA).repartition(4)
    found = vg.near_duplicates(frame, **settings)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=repr)


def noisy(rng, base, angle):
    v = rng.normal(size=len(base))
    v -= v @ base / (base @ base) * base
    v *= np.linalg.norm(base) / np.linalg.norm(v)
    return math.cos(angle) * base + math.sin(angle) * v


def as_rows(vectors, start=0):
    return [(start + i, [float(c) for c in np.asarray(v, np.float32)]) for i, v in enumerate(vectors)]


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = list(rng.normal(size=(500, 32)))
    for i in range(60):
        vectors += [noisy(rng, vectors[i], a) for a in rng.uniform(0, 0.3, rng.integers(1, 6))]
    for i in range(30):
        vectors += [vectors[i], 3 * vectors[i]]
    rng.shuffle(vectors)
    rows = as_rows(vectors)
    assert result(spark, rows) == brute_force(rows)


def test_groups_at_all_distances(spark, monkeypatch):
    """Dense groups whose members straddle the limit: balls, points at their edge, and neighbouring balls."""
    monkeypatch.setattr(vg, "BLOCK", 16)
    rng = np.random.default_rng(2)
    vectors = list(rng.normal(size=(150, 24)))
    for base, spread, n in ((0, 0.12, 150), (1, 0.2, 80), (2, 0.3, 80), (3, 0.05, 60)):
        vectors += [noisy(rng, vectors[base], a) for a in rng.uniform(0, spread, n)]
    second = noisy(rng, vectors[0], 0.35)
    vectors += [noisy(rng, second, a) for a in rng.uniform(0, 0.12, 60)]
    vectors += [vectors[200]] * 7
    rows = as_rows(vectors)
    seen = []
    original = vg._member_links
    monkeypatch.setattr(vg, "_member_links", lambda *a: seen.append(1) or original(*a))
    assert result(spark, rows) == brute_force(rows)
    assert seen


def test_many_pieces_and_parts(spark, monkeypatch):
    monkeypatch.setattr(vg, "PIECE", 60)
    monkeypatch.setattr(vg, "QUERIES", 50)
    rng = np.random.default_rng(3)
    vectors = list(rng.normal(size=(200, 16)))
    vectors += [noisy(rng, vectors[i % 50], a) for i, a in enumerate(rng.uniform(0, 0.3, 150))]
    rows = as_rows(vectors)
    assert result(spark, rows) == brute_force(rows)


def test_one_group_a_third_of_the_table(spark):
    rng = np.random.default_rng(4)
    vectors = list(rng.normal(size=(600, 32)))
    vectors += [noisy(rng, vectors[0], a) for a in rng.uniform(0, 0.1, 150)] + [vectors[1]] * 150
    rows = as_rows(vectors)
    assert result(spark, rows) == brute_force(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
        (None, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0]), (10, [5.0]), (None, [0.0, 1.0]), (None, None), (11, [1e38, 1e38]), (12, [1e-38, 1e-38]),
        (13, [-0.0, 1.0, 0.0]), (14, [0.0, 1.0, -0.0]),
    ]
    assert result(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_recall_is_measured_against_brute_force(spark):
    rows = [(i, v.tobytes(), 1) for i, v in enumerate(np.tile(np.eye(8), (5, 1)))]
    nodes = spark.createDataFrame(rows, "node long, unit binary, copies long")
    full = spark.createDataFrame([(i, 4) for i in range(40)], "node long, n_links long")
    half = spark.createDataFrame([(i, 2) for i in range(40)], "node long, n_links long")
    assert vg.recall(nodes, full) == 1
    assert vg.recall(nodes, half) == pytest.approx(0.5)


def test_graph_alone_reaches_its_neighbours():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = np.array([noisy(rng, v, 0.2) for v in x[:300]])
    found = vg.range_search(x, vg.neighbours_of(x), q, np.full(300, -1), np.full(300, 0.95))
    hit = {(i, j) for i, j in zip(*(a.tolist() for a in found), strict=True)}
    assert sum((i, i) in hit for i in range(300)) >= 270
