"""ROC curves against their area and a direct count; permutation importance against a loop over features."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import near
from perfwatch.operators.evaluate import roc_auc, roc_curve
from perfwatch.operators.importance import model_score, permutation_importance
from perfwatch.operators.ordering import Layout


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for key, size, share in (("a", 300, 0.3), ("b", 40, 0.5), ("only", 12, 1.0), (None, 30, 0.4)):
        for _ in range(size):
            rows.append((key, int(rng.random() < share), rng.choice([None, 0.0, 0.25, 0.5, 1.0, round(rng.random(), 2)])))
    return spark.createDataFrame(rows, "key string, y_true int, anomaly_probability double").repartition(5)


@pytest.mark.parametrize("layout", [Layout(("key",)), Layout(("key",), True, 7)])
def test_curve_has_the_area_and_no_straight_points(scored, layout):
    curves = {}
    for r in roc_curve(scored, ["key"], layout=layout).collect():
        curves.setdefault(r["key"], []).append(r)
    areas = {r["key"]: r["roc_auc"] for r in roc_auc(scored, ["key"]).collect()}
    data = [r for r in scored.collect() if r["anomaly_probability"] is not None]
    assert set(curves) == {"a", "b", "only", None}
    for key, points in curves.items():
        points.sort(key=lambda r: (r["tp"], r["fp"]))
        own = [r for r in data if r["key"] == key]
        for p in points:
            over = [r for r in own if p["threshold"] is not None and r["anomaly_probability"] >= p["threshold"]]
            assert (p["tp"], p["fp"]) == (sum(r["y_true"] for r in over), sum(1 - r["y_true"] for r in over))
        assert points[0]["threshold"] is None and points[-1]["tp"] + points[-1]["fp"] == len(own)
        if key == "only":
            assert areas[key] is None and all(p["fpr"] is None for p in points) and len(points) == 2
            continue
        pairs = list(zip(points, points[1:]))
        assert near(sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in pairs), areas[key])
        for (a, b), (_, c) in zip(pairs, pairs[1:]):
            assert (b["tp"] - a["tp"]) * (c["fp"] - b["fp"]) != (b["fp"] - a["fp"]) * (c["tp"] - b["tp"]) or a["threshold"] is None


def test_curve_of_nothing(spark):
    empty = spark.createDataFrame([], "key string, y_true int, anomaly_probability double")
    assert roc_curve(empty, ["key"]).count() == 0


def test_importance_of_a_fitted_model(spark):
    rng = random.Random(12)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 2), rng.gauss(0, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double").withColumn("target", 3 * F.col("x") - F.col("y"))
    names = ["x", "y", "z"]
    model = LinearRegression(featuresCol="features", labelCol="target").fit(VectorAssembler(inputCols=names, outputCol="features").transform(df))
    found = {r["feature"]: r["importance"] for r in permutation_importance(df, names, "target", ["id"], model_score(model), seed=5).collect()}
    ordered = sorted(rows, key=lambda r: (hashlib.md5(f"5|{r[0]}".encode()).hexdigest(), r[0]))
    for place, name in enumerate(names):
        total = 0.0
        for i, row in enumerate(ordered):
            values = list(row[1:])
            values[place] = ordered[(i + 1) % len(ordered)][place + 1]
            total += abs(sum(c * v for c, v in zip(model.coefficients, values)) + model.intercept - (3 * row[1] - row[2]))
        assert near(found[name], total / len(rows), 1e-6)
    assert found["x"] > found["y"] > abs(found["z"])
    one = permutation_importance(df.limit(1), names, "target", ["id"], model_score(model)).collect()
    assert all(near(r["importance"], 0) for r in one)
