"""The stages against brute force on their own inputs, and the registration of the queries."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from perfwatch.llm import mixing


def test_every_operator_and_the_pipeline_are_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """The rows that each stage gets and gives."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    columns = docs.columns
    for i, (name, step) in enumerate(cp.STAGES):
        step(spark, docs, sf).write.parquet(f"{folder}/{i}")
        after = spark.read.parquet(f"{folder}/{i}")
        assert name == "shard" or after.columns == columns
        out.append(({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}))
        docs = after
    return out


def test_stages_keep_rows_unchanged(steps):
    for before, after in steps[:-1]:
        assert after and all(before[i] == r for i, r in after.items())


def test_language_keeps_texts_with_letters(steps):
    before, after = steps[0]
    assert all(any(c.isalpha() for c in r.text or "") for r in after.values())
    assert len(after) >= 0.97 * len(before)


def test_one_document_of_each_group_stays(steps):
    def shingles(text):
        w = text.lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])

    before, after = steps[1]
    bags = {i: shingles(r.text) for i, r in before.items()}
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = sum((bags[i] & bags[j]).values())
            if both >= 0.8 * (bags[i].total() + bags[j].total() - both):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    assert set(after) == {i for i in ids if root(i) == i}


def test_leaking_documents_go_and_clean_ones_stay(spark, sf, steps):
    items = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = steps[2]
    dirty = {i for i, r in before.items() if any(f" {x} " in f" {' '.join(re.findall(r'[^\W_]+', r.text.lower()))} " for x in items)}
    assert dirty and set(after) == set(before) - dirty


def test_the_mixture_is_nearer_to_its_targets(steps):
    before, after = steps[3]

    def error(rows):
        tokens = Counter()
        for r in rows.values():
            tokens[r.lang] += len(r.text.split())
        start = Counter()
        for r in before.values():
            start[r.lang] += len(r.text.split())
        want = {k: v**mixing.FLATTEN for k, v in start.items()}
        return sum(abs(tokens[k] / tokens.total() - v / sum(want.values())) for k, v in want.items())

    assert 0 < len(after) < len(before) and error(after) < error(before) + 0.05


def test_all_that_is_left_is_sharded(steps):
    before, after = steps[4]
    assert set(before) == set(after)
    n = Counter(r.shard for r in after.values())
    assert set(n) == set(range(8)) and max(n.values()) - min(n.values()) <= 1


def test_run_gives_the_rows_of_the_last_stage(spark, sf, steps):
    assert {(r.doc_id, r.shard, r.slot) for r in cp.run(spark, sf).collect()} == {(r.doc_id, r.shard, r.slot) for r in steps[4][1].values()}


def test_an_empty_table_runs_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, step in cp.STAGES:
        following = step(spark, docs, sf)
        assert following.count() == 0
        docs = following if following.columns == docs.columns else docs
