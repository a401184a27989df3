"""Chunked and plain layouts must give the same rows, whatever the partitioning."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import near
from perfwatch.operators import ordering, quantile
from perfwatch.operators.ordering import Layout, by_group_size, in_order, measure, measure_nested, positions, running_total
from perfwatch.operators.quantile import exact_quantiles

PLAIN = Layout(("key",))
SPLIT = Layout(("key",), split=True, chunk=7)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for key, size in (("hot", 400), ("small", 5), ("one", 1), ("mid", 60)):
        for i in range(size):
            value = None if rng.random() < 0.1 else float(rng.choice([0, 0, 0, rng.randint(-50, 50), rng.random()]))
            data.append((key, rng.randint(0, 20), i, value))
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, window_id long, seq long, value double").repartition(5).persist()


def both(function):
    plain = sorted((tuple(r) for r in function(PLAIN).collect()), key=repr)
    split = sorted((tuple(r) for r in function(SPLIT).collect()), key=repr)
    return plain, split


def test_measure_counts_the_largest_group(rows):
    assert not measure(rows, ["key"], 400).split
    assert measure(rows, ["key"], 399).split
    assert measure(rows, [], 465).split
    inner, outer = measure_nested(rows, ["key"], ["key", "window_id"], 30)
    assert not inner.split and not outer.split
    assert measure_nested(rows, ["key"], ["key", "window_id"], 20) == (
        Layout(("key", "window_id"), True), Layout(("key",), True))


def test_positions_are_dense_and_equal(rows):
    plain, split = both(lambda lay: positions(rows, lay, ["window_id", "seq"], "pos", "n"))
    assert plain == split
    hot = sorted(r[4] for r in plain if r[0] == "hot")
    assert hot == list(range(400))


def test_positions_without_key(rows):
    order = ["key", "seq"]
    plain = positions(rows, Layout(()), order).select("key", "seq", "pos").collect()
    split = positions(rows, Layout((), split=True), order).select("key", "seq", "pos").collect()
    assert sorted(plain) == sorted(split)


def test_chunks_see_their_neighbours(rows):
    def run(layout):
        placed = positions(rows, layout, ["seq"], "pos")
        return in_order(placed, layout, "pos", 3, 2, lambda w: {
            "back": F.lag("seq", 3).over(w),
            "ahead": F.lead("seq", 2).over(w),
            "last": F.lag(F.struct("seq", "value"), 1).over(w)["value"],
            "count": F.count("value").over(w.rowsBetween(-2, 0)),
        })

    plain, split = both(run)
    assert plain == split
    assert len(plain) == 466


def test_frame_longer_than_a_chunk_is_refused(rows):
    with pytest.raises(ValueError):
        in_order(rows, SPLIT, "seq", 8, 0, lambda w: {"x": F.lag("seq", 8).over(w)})


def test_running_total(rows):
    plain, split = both(lambda lay: running_total(rows.na.fill(0.0), lay, ["window_id", "seq"], "seq"))
    assert plain == split


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 0.95, 1.0])
def test_quantiles_match_numpy_in_both_layouts(rows, q):
    expected = {}
    for r in rows.where("value is not null").collect():
        expected.setdefault(r["key"], []).append(r["value"])
    for layout in (PLAIN, SPLIT):
        found = {r["key"]: r["v"] for r in exact_quantiles(rows, layout, {"v": ("value", q)}).collect()}
        for key, values in expected.items():
            assert near(found[key], float(np.quantile(values, q))), (key, layout)


def test_quantile_of_whole_frame_and_of_nothing(spark, rows):
    values = [r["value"] for r in rows.where("value is not null").collect()]
    for split in (False, True):
        found = exact_quantiles(rows, Layout((), split), {"v": ("value", 0.95)}).first()["v"]
        assert near(found, float(np.quantile(values, 0.95)))
    empty = spark.createDataFrame([("a", None), ("b", 1.0)], "key string, value double")
    got = {r["key"]: r["v"] for r in exact_quantiles(empty, SPLIT, {"v": ("value", 0.5)}).collect()}
    assert got == {"a": None, "b": 1.0}


@pytest.mark.parametrize("bins", [16, 1024])
def test_histograms_refine_to_the_rank(spark, monkeypatch, bins):
    """Ties, huge spans, infinite ends and few bins."""
    monkeypatch.setattr(quantile, "BINS", bins)
    rng = random.Random(8)
    groups = {
        "ties": [1.0] * 50 + [2.0] * 50, "span": [-1.7e308, 1.7e308] + [rng.gauss(0, 1e-300) for _ in range(60)],
        "ends": [float("-inf"), float("inf")] + [rng.random() for _ in range(41)], "one": [3.5], "zeros": [0.0, -0.0, 0.0],
        "none": [None, None], "skew": [2.0 ** -i for i in range(40)],
    }
    rows = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "key string, value double").repartition(4)
    wanted = {"low": 0.25, "mid": 0.5, "top": 1.0}
    found = {r["key"]: r for r in exact_quantiles(rows, SPLIT, {n: ("value", q) for n, q in wanted.items()}).collect()}
    assert found["none"]["mid"] is None and set(found) == set(groups)
    assert found["ends"]["top"] == float("inf")
    for key, values in groups.items():
        for name, q in wanted.items():
            if key != "none" and (key, name) != ("ends", "top"):
                assert near(found[key][name], float(np.quantile(values, q))), (key, q)


def test_no_task_sorts_a_whole_frame(rows):
    plan = exact_quantiles(rows, Layout((), split=True), {"v": ("value", 0.5)})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.replace("WindowGroupLimit", "")


def test_only_large_groups_are_split(spark, rows, monkeypatch):
    """One large group among many: the others take one exchange by key and meet no range partition."""
    many = rows.unionByName(spark.range(3000).selectExpr("concat('k', id % 600) AS key", "id % 7 AS window_id", "id AS seq", "cast(id AS double) AS value"))
    layout = measure(many, ["key"], 100)
    assert layout.split and [r[0] for r in layout.heavy.collect()] == ["hot"]

    staged = []
    original = ordering.stage
    monkeypatch.setattr(ordering, "stage", lambda df, label: staged.append((label, df.count())) or original(df, label))

    def chain(df, layout):
        placed = positions(df, layout, ["window_id", "seq"], "pos", "n")
        return in_order(placed, layout, "pos", 3, 1, lambda w: {"back": F.lag("seq", 3).over(w), "ahead": F.lead("value", 1).over(w)})

    routed = by_group_size(chain)(many, replace(layout, chunk=50))
    plain = chain(many, PLAIN)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, routed.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert staged == [("ordered", 400)]
    by_key = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(key#\d+, \d+\)", x)]
    assert len(by_key) == 2  # the rows of small groups, and one row for each range partition of a large one


def test_result_does_not_depend_on_partitions(spark, rows):
    results = []
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        placed = positions(rows.repartition(int(partitions)), SPLIT, ["window_id", "seq"], "pos", "n")
        results.append(sorted(map(tuple, placed.collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_null_keys_are_groups_on_both_plans(spark):
    from perfwatch.operators import ordering as od
    from perfwatch.operators.labels import label, training_prefix
    rows = [(k, i, float((i * 7) % 11) if i % 5 else None) for k in ("a", None) for i in range(40)]
    df = spark.createDataFrame(rows, "sample_key string, seq long, p95_latency double")
    plain, split = od.Layout(("sample_key",)), od.Layout(("sample_key",), True, 10)

    def same(make):
        first, second = (sorted(map(tuple, make(layout).collect()), key=repr) for layout in (plain, split))
        assert first == second and any(r[0] is None for r in first)

    same(lambda x: od.positions(df, x, ["seq"], "pos", "n").select("sample_key", "seq", "pos", "n"))
    same(lambda x: od.running_total(df.fillna(0.0, ["p95_latency"]), x, ["seq"], "p95_latency").select("sample_key", "seq", "running"))
    same(lambda x: exact_quantiles(df, x, {"q": ("p95_latency", 0.95)}).select("sample_key", "q"))
    same(lambda x: label(df, x).select("sample_key", "seq", "latency_anomaly"))
    assert od.group_sizes(df, ["sample_key"]).where("n = 40").count() == 80
    assert training_prefix(df, ["sample_key"]).count() == 56
