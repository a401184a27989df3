"""The curve, the law of the shards, pruning, and the edges of the input."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest

from perfwatch.llm import sharding as sh


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 6, 7) for r in rows], "doc_id long, text string, lang string, source string, size int, position int, cell int")


def check(rows, got, n=8):
    assert sorted(repr((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t, *_ in rows) == sorted(
        repr((r.doc_id, r.size, r.text_crc32)) for r in got
    )
    by = [sorted(r.slot for r in got if r.shard == s) for s in range(n)]
    assert all(slots == list(range(len(slots))) for slots in by)
    assert max(map(len, by)) - min(map(len, by)) <= 1 and sum(map(len, by)) == len(got)
    assert {(r.law, r.grown_shard) for r in got} <= {("rows", None)}


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_in_unit_steps(dimensions, bits):
    cells = {sh.hilbert_index(p, bits): p for p in itertools.product(range(1 << bits), repeat=dimensions)}
    assert sorted(cells) == list(range(1 << bits * dimensions))
    path = [cells[i] for i in sorted(cells)]
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in itertools.pairwise(path))


def test_shards_of_the_documents_prune_on_every_dimension(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = sh.shards(docs).collect()
    check(rows, got)
    shard = {r.doc_id: r.shard for r in got}
    spread = lambda key: sum(len({shard[r[0]] for r in rows if key(r) == v}) for v in {key(r) for r in rows}) / len({key(r) for r in rows})
    assert spread(lambda r: r[3]) < 5 and spread(lambda r: r[2]) < 8


@pytest.mark.parametrize("n", [0, 1, 3, 8, 13])
def test_small_tables(spark, n):
    rows = [(i, "t" * i, "a", "s") for i in range(n)]
    check(rows, sh.shards(frame(spark, rows)).collect())


def test_nulls_ties_repeats_long_texts_and_a_hot_source(spark):
    rng = random.Random(1)
    rows = [(1, None, None, None), (2, "", "a", None), (3, "same", "a", "s"), (3, "same", "a", "s"), (None, "same", "a", "s"), (4, "é" * 500_000, "ü", "日")]
    rows += [(10 + i, "x" * rng.randrange(50), "a", "hot") for i in range(400)] + [(500 + i, "same", "a", "s") for i in range(200)]
    check(rows, sh.shards(frame(spark, rows)).collect())
    check(rows, sh.shards(frame(spark, rows), 5).collect(), 5)


def test_text_order_numbers_follow_the_values(spark):
    values = [None, "", "a", "ab", "b", "src1", "src10", "src2", "é"]
    df = spark.createDataFrame([(v,) for v in values], "lang string")
    got = [r.n for r in df.select("lang", sh._order_number("lang", 0).alias("n")).orderBy("lang").collect()]
    assert got == sorted(got) and len(set(got)) == len(values)
