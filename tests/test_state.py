from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import near
from perfwatch.operators import families as fam
from perfwatch.operators.dynamics import add_dynamics, dynamic_columns
from perfwatch.operators.labels import label, thresholds
from perfwatch.operators.ordering import Layout
from perfwatch.operators.state import fill_state, state_from_long, system_state
from perfwatch.plans.preprocessing import aggregated

LAYOUT = Layout(("sample_key",))
CPU, MEM = "container_cpu_usage_seconds_total", "container_memory_usage_bytes"


def frame(spark, columns, rows):
    named = [("s", i, *r) for i, r in enumerate(rows)]
    schema = "sample_key string, seq long, " + ", ".join(f"`{c}` {t}" for c, t in columns.items())
    return spark.createDataFrame(named, schema)


def state_of(spark, columns, rows):
    return fill_state(system_state(frame(spark, columns, rows))).orderBy("seq").collect()


def test_all_null_latency_row(spark):
    row = state_of(spark, {f"{i}_latency": "double" for i in range(3)}, [(None, None, None)])[0]
    assert (row["p50_latency"], row["p95_latency"], row["std_latency"], row["latency_service_count"]) == (0, 0, 0, 0)


def test_one_service_has_no_deviation(spark):
    row = state_of(spark, {"7_latency": "double"}, [(5.0,)])[0]
    assert row["std_latency"] == 0 and row["p95_latency"] == 5 and row["max_latency"] == 5


def test_row_statistics_match_numpy(spark):
    rng = np.random.default_rng(0)
    data = [tuple(None if rng.random() < 0.2 else float(v) for v in rng.normal(size=6)) for _ in range(40)]
    got = state_of(spark, {f"{i}_latency": "double" for i in range(6)}, data)
    for values, row in zip(data, got):
        kept = [v for v in values if v is not None]
        for name, p in (("p50_latency", 0.5), ("p90_latency", 0.9), ("p95_latency", 0.95)):
            assert near(row[name], float(np.quantile(kept, p)), 1e-12)
        assert near(row["mean_latency"], float(np.mean(kept)), 1e-12)
        assert near(row["std_latency"], float(np.std(kept, ddof=1)) if len(kept) > 1 else 0.0, 1e-12)


def test_absent_family(spark):
    columns = {"0_latency": "double", f"0_{MEM}": "double"}
    rows = [(float(i), float(i)) for i in range(12)]
    state = fill_state(system_state(frame(spark, columns, rows)))
    row = state.first()
    assert row["cpu_available"] == 0 and row["memory_available"] == 1
    assert row["cpu_total"] is None and row["latency_to_cpu_ratio"] is None and row["resource_pressure"] is None
    flags = label(state, LAYOUT).orderBy("seq").collect()
    assert {r["cpu_anomaly"] for r in flags} == {0}
    assert flags[-1]["latency_anomaly"] == 1 and flags[-1]["system_anomaly"] == 1


def test_zero_denominator_and_empty_total(spark):
    columns = {"0_latency": "double", f"0_{CPU}": "double", f"1_{CPU}": "double"}
    rows = state_of(spark, columns, [(4.0, 0.0, 0.0), (4.0, None, None), (4.0, 1.0, 1.0)])
    assert [r["latency_to_cpu_ratio"] for r in rows[:2]] == [0, 0]
    assert rows[1]["cpu_total"] == 0 and rows[1]["cpu_max"] == 0 and rows[1]["cpu_service_count"] == 0
    assert near(rows[2]["latency_to_cpu_ratio"], 4.0 / (2.0 + 1e-9), 1e-15)


def test_nan_and_infinity_are_missing(spark):
    rows = state_of(spark, {"0_latency": "double", "1_latency": "double"}, [(math.nan, 3.0), (math.inf, -math.inf)])
    assert rows[0]["mean_latency"] == 3 and rows[0]["latency_service_count"] == 1
    assert rows[1]["latency_service_count"] == 0 and rows[1]["max_latency"] == 0


def test_missing_window_id_is_the_row_number(spark):
    assert [r["window_id"] for r in state_of(spark, {"0_latency": "double"}, [(1.0,), (2.0,)])] == [0, 1]


def test_percent_change_and_rolling(spark):
    values = [0.0, 0.0, 5.0, None, 2.0, 0.0]
    df = frame(spark, {"0_latency": "double"}, [(v,) for v in values])
    got = aggregated(df, LAYOUT).orderBy("seq").collect()
    assert [r["p95_latency_pct_change_1"] for r in got] == [0, 0, 0, 0, 0, -1]
    assert [r["p95_latency_diff_1"] for r in got] == [0, 0, 5, 0, 0, -2]
    df = frame(spark, {"0_latency": "double"}, [(v,) for v in (1.0, None, 3.0, 5.0)])
    got = aggregated(df, LAYOUT).orderBy("seq").collect()
    assert [near(r["p95_latency_rolling_std_3"], e) for r, e in zip(got, (0, 0, math.sqrt(2), math.sqrt(2)))] == [True] * 4
    assert [r["p95_latency_rolling_mean_3"] for r in got] == [1, 1, 2, 4]


def test_chunked_dynamics_equal_plain_ones(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in rng.normal(size=2)) for _ in range(50)]
    df = frame(spark, {"0_latency": "double", f"0_{CPU}": "double"}, rows)
    plain = aggregated(df, LAYOUT).orderBy("seq").collect()
    chunked = aggregated(df, Layout(("sample_key",), True, 6)).orderBy("seq").collect()
    for a, b in zip(plain, chunked):
        assert all(near(x, y) if isinstance(x, float) else x == y for x, y in zip(a, b))


def test_rolling_window_names(spark):
    df = frame(spark, {"0_latency": "double"}, [(1.0,), (2.0,)])
    moved = add_dynamics(system_state(df), LAYOUT, 5)
    assert "p95_latency_rolling_mean_5" in moved.columns
    assert dynamic_columns(moved.columns, 5)["p95_latency_rolling_std_5"] == "p95_latency"


def test_family_discovery(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 3.0, 4.0, 5.0, "x", 6.0)],
        f"window_id int, `10_latency` double, `2_latency` double, `2_Latency` double, `1_pod_{CPU.upper()}` double, `2_{CPU}` string, latency double",
    )
    assert fam.exact_columns(df, "latency") == ["2_latency", "10_latency"]
    assert fam.token_columns(df, [CPU]) == [f"1_pod_{CPU.upper()}"]
    assert fam.token_columns(df, [CPU], numeric_only=False) == [f"1_pod_{CPU.upper()}", f"2_{CPU}"]


def test_long_form_gives_the_same_state(spark):
    rows = [(float(i), float(i * i % 7), float(i % 3)) for i in range(9)]
    df = frame(spark, {"0_latency": "double", "1_latency": "double", f"0_{CPU}": "double"}, rows)
    wide = fill_state(system_state(df)).orderBy("seq").collect()
    long = fam.to_long(df, ["sample_key", "seq"])
    plain = fill_state(state_from_long(long, ["sample_key", "seq"])).orderBy("seq").collect()
    split = Layout(("sample_key", "seq"), True)
    also = fill_state(state_from_long(long, ["sample_key", "seq"], layout=split)).orderBy("seq").collect()
    for a, b in zip(wide + wide, plain + also):
        for c in ("p50_latency", "p95_latency", "std_latency", "cpu_total", "latency_to_cpu_ratio", "memory_total"):
            assert near(a[c], b[c])
        assert (a["memory_available"], a["cpu_available"]) == (b["memory_available"], b["cpu_available"]) == (0, 1)


def test_threshold_prefix_has_at_least_one_row(spark):
    df = fill_state(system_state(frame(spark, {"0_latency": "double"}, [(3.0,)])))
    assert thresholds(df, LAYOUT).first()["latency_threshold"] == 3
    with pytest.raises(ValueError):
        thresholds(df, LAYOUT, fraction=0.0)
