from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from perfwatch.operators.labels import thresholds, training_prefix
from perfwatch.operators.ordering import Layout
from perfwatch.operators.predictive import flatten_lags, predictive_dataset
from perfwatch.operators.state import fill_state, system_state
from perfwatch.plans.preprocessing import Settings, marked, predictive, status

PLAIN, SPLIT = Layout(("sample_key",)), Layout(("sample_key",), True, 8)


def telemetry(spark, sizes, text_label=False, permuted=True):
    rng = random.Random(5)
    data = []
    for sample, n in sizes.items():
        windows = list(range(n))
        if permuted:
            rng.shuffle(windows)
        for seq, window in enumerate(windows):
            label = (None if window % 6 == 5 else "x") if text_label else window % 2
            data.append((sample, seq, window * 2, label, rng.random() * 100, rng.random(), rng.random()))
    kind = "string" if text_label else "int"
    return spark.createDataFrame(
        data,
        f"sample_key string, seq long, window_id long, label_trace {kind}, `0_latency` double,"
        " `0_container_cpu_usage_seconds_total` double, `0_container_memory_usage_bytes` double",
    )


def test_layouts_agree_with_unsorted_windows(spark):
    df = telemetry(spark, {"a": 41, "b": 30, "c": 3})
    plain, split = (
        sorted(map(tuple, flatten_lags(predictive(df, lay)).drop("n").collect()), key=lambda r: (r[0], r[2]))
        for lay in (PLAIN, SPLIT)
    )
    assert len(plain) == len(split) == 37 + 26
    for a, b in zip(plain, split):
        for x, y in zip(a, b):
            assert x == y or abs(x - y) < 1e-9


def test_lags_follow_windows_and_dynamics_follow_file_order(spark):
    df = telemetry(spark, {"a": 20})
    source = {r["window_id"]: r for r in df.collect()}
    by_seq = {r["seq"]: r for r in df.collect()}
    for row in predictive(df, PLAIN).collect():
        w = row["window_id"]
        assert row["lag_2"]["p95_latency"] == source[w - 4]["0_latency"]
        assert row["target_p95_latency_t_plus_1"] == source[w + 2]["0_latency"]
        assert row["target_label_trace_t_plus_1"] == source[w + 2]["label_trace"]
        before = by_seq.get(row["seq"] - 1)
        expected = row["p95_latency"] - before["0_latency"] if before else 0.0
        assert abs(row["p95_latency_diff_1"] - expected) < 1e-9


@pytest.mark.parametrize("horizon", [1, 2])
def test_split_sizes_truncate(spark, horizon):
    df = telemetry(spark, {"a": 30 + horizon})
    got = predictive(df, PLAIN, Settings(horizon=horizon)).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 18, "val": 4, "test": 5}


def test_horizon_zero_and_bad_fractions_are_refused(spark):
    df = marked(telemetry(spark, {"a": 10}), PLAIN)
    with pytest.raises(ValueError):
        predictive_dataset(df, PLAIN, horizon=0)
    with pytest.raises(ValueError):
        predictive_dataset(df, PLAIN, train=0.9)


def test_text_label_missing_at_target_drops_the_row(spark):
    df = telemetry(spark, {"a": 24}, text_label=True)
    got = predictive(df, PLAIN)
    assert got.count() == 20 - 4  # windows 6k + 4 lose their target
    assert got.where("target_label_trace_t_plus_1 is null").isEmpty()
    splits = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert splits == {"train": 11, "val": 2, "test": 3}


def test_tiny_sample_fails_and_others_go_on(spark):
    df = telemetry(spark, {"tiny": 4, "short": 12, "ok": 40})
    found = {r["sample_key"]: r for r in status(df, predictive(df, PLAIN)).collect()}
    assert found["tiny"]["reason"] == "too few rows after aggregation"
    assert found["short"]["reason"] == "too few rows after predictive processing"
    assert found["ok"]["status"] == "ok" and found["ok"]["predictive_rows"] == 36
    assert found["tiny"]["predictive_rows"] == 0


def test_suitability_gate(spark):
    df = telemetry(spark, {"ok": 40}).drop("0_container_cpu_usage_seconds_total", "0_container_memory_usage_bytes")
    settings = Settings(require_measures=True)
    assert status(df, predictive(df, PLAIN), settings).first()["reason"] == "required metrics are missing"


def test_thresholds_ignore_rows_after_the_prefix(spark):
    df = fill_state(system_state(telemetry(spark, {"a": 40}, permuted=False)))
    changed = df.withColumn("p95_latency", F.when(F.col("seq") >= 28, F.lit(1e9)).otherwise(F.col("p95_latency")))
    assert thresholds(df, PLAIN).first() == thresholds(changed, PLAIN).first()
    touched = df.withColumn("p95_latency", F.when(F.col("seq") >= 27, F.lit(1e9)).otherwise(F.col("p95_latency")))
    assert thresholds(df, PLAIN).first() != thresholds(touched, PLAIN).first()


def test_features_do_not_see_the_future(spark):
    df = telemetry(spark, {"a": 40}, permuted=False)
    changed = df.withColumn("0_latency", F.when(F.col("seq") >= 36, F.lit(0.0)).otherwise(F.col("0_latency")))
    a = {r["seq"]: r for r in predictive(df, PLAIN).collect()}
    b = {r["seq"]: r for r in predictive(changed, PLAIN).collect()}
    assert all(a[s] == b[s] for s in a if s < 35)
    assert a[35] != b[35]  # its target is row 36


def test_prefix_length(spark):
    df = telemetry(spark, {"a": 10, "b": 1})
    got = training_prefix(df, ["sample_key"]).groupBy("sample_key").count().collect()
    assert {r[0]: r[1] for r in got} == {"a": 7, "b": 1}
