from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import near
from perfwatch.operators import evaluate as ev
from perfwatch.operators import health
from perfwatch.operators import ml
from perfwatch.operators import reports as rep
from perfwatch.operators import services as svc
from perfwatch.operators.ordering import Layout

LOW, MID, HIGH = rep.SEVERITIES


def panel(spark, rows):
    return spark.createDataFrame(rows, "scenario string, step int, service string, p95_latency double, system_anomaly int")


@pytest.mark.parametrize("values, expected", [
    ([0.0, 1.0, 2.0, 3.0], [LOW, LOW, MID, HIGH]), ([5.0, 5.0], [MID, MID]), ([5.0], [MID]), ([1.0, None, 4.0], [LOW, None, HIGH]),
])
def test_severity_bins(spark, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = df.withColumn("s", rep.severity(F.col("v"))).orderBy("i").collect()
    assert [r["s"] for r in got] == expected


def test_incident_log_and_critical_filter_after_binning(spark):
    df = panel(spark, [("a", s, "x", float(s), int(s >= 6)) for s in range(10)])
    log = rep.report_data(df).orderBy("step").collect()
    assert [r["severity"] for r in log] == [LOW, LOW, MID, HIGH]
    assert [r["status"] for r in log] == rep.LOG_STATUSES
    assert [r["step"] for r in rep.report_data(df, only_critical=True).collect()] == [9]
    assert str(log[0]["event_time"]) == "2025-04-10 08:30:00"


def test_without_flags_the_slowest_rows_are_kept(spark):
    df = panel(spark, [("a", s, "x", float(s), 0) for s in range(30)])
    got = rep.incidents(df, ["step", "service"], 8, 20, rep.TABLE_STATUSES).collect()
    assert sorted(r["step"] for r in got) == list(range(22, 30))
    by_quantile = rep.incidents(df.drop("system_anomaly"), ["step", "service"]).collect()
    assert sorted(r["step"] for r in by_quantile) == [28, 29]


def test_period_filter_and_services(spark):
    df = panel(spark, [("a", s, "x" if s % 2 else "y", 1.0, 0) for s in range(20)])
    assert rep.filter_period(df, 12).count() == 12 and rep.filter_period(df, None).count() == 20
    assert rep.filter_services(df, []).count() == 20 and rep.filter_services(df, ["x"]).count() == 10


def test_trend_grid_has_zero_rows(spark):
    log = spark.createDataFrame([("2025-04-10 08:00:00", LOW), ("2025-04-11 08:05:00", HIGH)], "event_time string, severity string")
    rows = rep.incident_trend(log.withColumn("event_time", F.col("event_time").cast("timestamp"))).collect()
    assert len(rows) == 6 and sorted(r["events"] for r in rows) == [0, 0, 0, 0, 1, 1]


def test_summary_of_an_empty_log(spark):
    df = panel(spark, [("a", 1, "x", 1.0, 1)])
    row = rep.operational_summary(rep.report_data(df).limit(0), "all", 3).first()
    assert (row["event_count"], row["critical_count"], row["critical_share"], row["mean_p95"], row["peak_service"]) == (0, 0, 0, 0, "-")
    text = {r["indicator"]: r["value"] for r in rep.summary_rows(rep.operational_summary(rep.report_data(
        panel(spark, [("a", 1, "x", 123456.0, 1)])), "all", 3)).collect()}
    assert text["Средняя p95 latency"] == "123 456" and text["Доля критических событий"] == "0.0 %"


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (2, 5.0, 0.0)], "step int, a double, b double")
    assert {r["a"] for r in rep.min_max_scaled(df, ["a"]).collect()} == {0.0}
    assert {r["b"] for r in rep.scaled_by_maximum(df, ["b"], ["step"]).collect()} == {0.0}


def test_best_model_and_default(spark):
    df = spark.createDataFrame([("a", "m1", "test", 2.0, 1.0), ("a", "m2", "test", 1.0, 9.0), ("a", "m3", "train", 0.0, 0.0)],
                               "scenario string, model string, split string, rmse double, mae double")
    assert rep.best_model(df, "a").first()[0] == "m2"
    assert rep.best_model(df, "b").first()[0] == rep.DEFAULT_MODEL


def test_degrees_and_summary(spark):
    edges = spark.createDataFrame([("s", "u", "u"), ("s", "u", "v"), ("s", "w", "v")],
                                  "scenario string, source_service string, target_service string")
    got = {r["service"]: (r["rpc_out"], r["rpc_in"]) for r in svc.degrees(edges).collect()}
    assert got == {"u": (2, 1), "v": (0, 2), "w": (1, 0)}
    place = spark.createDataFrame([("u", "n1"), ("u", "n2")], "service string, node string")
    rows = {r["service"]: r for r in svc.service_summary(panel(spark, [("s", i, "v", 10.0 * i, i % 2) for i in range(40)]), edges, place).collect()}
    assert rows["u"]["node"] == "n1" and rows["v"]["node"] == "-"
    assert near(rows["v"]["risk_score"], 18 + 12 + 0.35 * 50) and rows["v"]["p95_latency"] == 295  # mean of 200..390
    assert rows["w"]["p95_latency"] == 95_000 + 4_200 * 22
    empty = edges.limit(0), panel(spark, [])
    assert [r[0] for r in svc.services_of(*empty).collect()] == ["system"]


def test_metrics_of_degenerate_groups(spark):
    df = spark.createDataFrame([("const_hit", 2.0, 2.0), ("const_hit", 2.0, 2.0), ("const_miss", 2.0, 3.0), ("const_miss", 2.0, 2.0), ("one", 1.0, 1.0)],
                               "g string, y_true double, y_pred double")
    got = {r["g"]: r["r2"] for r in ev.regression_metrics(df, ["g"]).collect()}
    assert got == {"const_hit": 1.0, "const_miss": 0.0, "one": None}
    binary = spark.createDataFrame([("neg", 0, 0, 0.1), ("neg", 0, 0, 0.2), ("ties", 1, 1, 0.5), ("ties", 0, 1, 0.5)],
                                   "g string, y_true int, y_pred int, anomaly_probability double")
    got = {r["g"]: r for r in ev.evaluate_predictions(binary, ["g"]).collect()}
    assert got["neg"]["roc_auc"] is None and got["neg"]["precision"] == 0 and got["neg"]["accuracy"] == 1
    assert got["ties"]["roc_auc"] == 0.5 and got["ties"]["recall"] == 1
    with pytest.raises(KeyError):
        ev.evaluate_predictions(binary.drop("y_pred"), ["g"])


def test_majority_and_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None), (0, None, None), (None, 3.0, None)], "y int, a double, b double")
    assert ml.majority_class(df, "y").first()[0] == 0  # tie goes to the smallest
    filled = ml.median_impute(df, ["a", "b"], F.lit(True), Layout(()))
    assert filled.columns == ["y", "a"] and [r["a"] for r in filled.collect()] == [1.0, 2.0, 3.0]


def test_source_health(spark):
    df = spark.createDataFrame(
        [("s", 5, 0, 1, 1, 1, None, False, 1.0, 2.0)],
        "sample_key string, rows int, cpu_available int, memory_available int, net_rx_available int, net_tx_available int,"
        " is_complete boolean, is_readable boolean, val_rmse double, test_rmse double")
    got = {r["rule"]: r["state"] for r in health.source_health(df).collect()}
    bad = {k for k, v in got.items() if v != health.NORMAL}
    assert bad == {"cpu_missing", "too_few_rows", "unreadable_file", "error_growth"}


def test_forest_beats_the_baseline(spark):
    rows = [(float(i), float(i % 7), float(3 * i + i % 7), "train" if i < 140 or i % 2 else "test") for i in range(200)]
    df = spark.createDataFrame(rows, "f1 double, f2 double, target_x double, split string").repartition(2)
    trained = ml.train_and_evaluate(df, "target_x", "regression", ("dummy", "random_forest"), random_forest=10)
    rmse = {(r["model"], r["split"]): r["rmse"] for r in trained.metrics.collect()}
    trained.release()
    assert rmse["random_forest", "test"] < rmse["dummy", "test"] / 2
