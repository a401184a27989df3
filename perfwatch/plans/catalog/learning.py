"""Queries of training, evaluation and metric tables.

Models are fitted on the whole training split, with the operators' defaults.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.operators import evaluate as ev
from perfwatch.operators import ml
from perfwatch.operators.importance import permutation_importance
from perfwatch.operators.ordering import join_on
from perfwatch.operators.predictive import flatten_lags
from perfwatch.operators.state import fill_state, system_state
from perfwatch.plans import inputs
from perfwatch.plans import preprocessing as prep
from perfwatch.plans.catalog.files import prediction_tree
from perfwatch.plans.catalog.registry import query, snap, snapped
from perfwatch.plans.catalog.sql import with_ctes
from perfwatch.plans.catalog.telemetry import _SPLIT_SQL, _WITH_TARGETS
from perfwatch.plans.training import TARGETS
from perfwatch.session import stage, staging_path
from perfwatch.sources import files as src

#: Trees or rounds of a model; the operators' own where none are given.
SIZES: dict[str, int] = {}
LATENCIES = [f"{s}_latency" for s in range(inputs.SERVICES)]


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The flat predictive dataset, written once because fitting reads it repeatedly."""
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    return stage(flatten_lags(prep.predictive(telemetry, layout)), "dataset")


_SPLIT_CTE = f"(SELECT *, {_SPLIT_SQL} FROM {_WITH_TARGETS} WHERE pos >= 3 AND pos < n - 1)"


@query("ml1_median_imputation", with_ctes(
    "SELECT t.sample_key, t.window_id, " + ", ".join(
        snap(f"coalesce(c{s}, (SELECT quantile_cont(c{s}, 0.5) FROM cells WHERE seq < floor(n::DOUBLE * 0.7::DOUBLE)))", f'"{s}_latency"')
        for s in range(inputs.SERVICES))
    + " FROM cells t", "raw_state").replace("\nSELECT t.", """,
cells AS (SELECT r.sample_key, r.window_id, r.seq, count(*) OVER (PARTITION BY r.sample_key) AS n, c0, c1, c2, c3
 FROM raw_state r JOIN (SELECT sample_key, window_id, """ + ", ".join(
        f"max(CASE WHEN service_id = {s} THEN latency END) AS c{s}" for s in range(inputs.SERVICES))
    + """ FROM tel GROUP BY 1, 2) USING (sample_key, window_id))
SELECT t."""))
def _(spark, sf):
    wide, _ = inputs.telemetry(spark, sf)
    rows = wide.select("sample_key", "window_id", "seq", "n", *LATENCIES)
    early = F.col("seq") < F.floor(F.col("n").cast("double") * F.lit(0.7))
    return snapped(ml.median_impute(rows, LATENCIES, early).drop("seq", "n"))


@query("ml2_baseline_regressor", with_ctes(
    f"SELECT split, {snap('raw_p95', 'y_true')}, "
    + snap(f"(SELECT quantile_cont(raw_p95, 0.5) FROM {_SPLIT_CTE} WHERE split = 'train')", "y_pred")
    + f" FROM {_SPLIT_CTE}", "pos"))
def _(spark, sf):
    return snapped(ml.baseline(dataset(spark, sf), TARGETS["regression"], "regression"))


def _fitted_sql(*models: str, counted: str = "count(*) AS row_count, ") -> str:
    named = ", ".join(f"('{m}')" for m in models)
    return with_ctes(
        f"SELECT model, split, {counted}TRUE AS in_range FROM {_SPLIT_CTE}, (VALUES {named}) AS m(model) GROUP BY ALL", "pos")


def _in_range(trained: ml.Trained, task: str) -> DataFrame:
    """Rows per model and split, and whether its metrics are possible ones."""
    if task == "regression":
        ok = F.col("mae").between(0, F.col("rmse") * (1 + 1e-9)) & (F.col("r2") <= 1)
    else:
        ok = reduce(and_, [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1")])
    counted = ["row_count"] if "row_count" in trained.metrics.columns else []
    return trained.metrics.select("model", "split", *counted, ok.alias("in_range"))


def _fit(spark: SparkSession, sf: str, task: str, *models: str) -> DataFrame:
    trained = ml.train_and_evaluate(dataset(spark, sf), TARGETS[task], task, models, **SIZES)
    found = stage(_in_range(trained, task), "fitted")
    trained.release()
    return found


@query("ml3_forest_regressor", _fitted_sql("random_forest"))
def _(spark, sf):
    return _fit(spark, sf, "regression", "random_forest")


@query("ml4_boosting_regressor", _fitted_sql("hist_gradient_boosting"))
def _(spark, sf):
    return _fit(spark, sf, "regression", "hist_gradient_boosting")


@query("ml5_baseline_classifier", with_ctes(f"""
 SELECT CAST(target_anomaly_t_plus_1 AS BIGINT) AS majority FROM {_SPLIT_CTE} WHERE split = 'train'
 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""", "pos"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    train = prep.predictive(telemetry, layout).where("split = 'train'")
    return snapped(ml.majority_class(train, TARGETS["classification"]))


@query("ml6_forest_classifier", _fitted_sql("random_forest", counted=""))
def _(spark, sf):
    return _fit(spark, sf, "classification", "random_forest")


@query("ml7_boosting_classifier", _fitted_sql("hist_gradient_boosting", counted=""))
def _(spark, sf):
    return _fit(spark, sf, "classification", "hist_gradient_boosting")


@query("ml8_positive_score", with_ctes(
    f"SELECT count(*) AS row_count, 0::BIGINT AS missing, 0::BIGINT AS outside FROM {_SPLIT_CTE} WHERE split = 'test'", "pos"))
def _(spark, sf):
    trained = ml.train_and_evaluate(dataset(spark, sf), TARGETS["classification"], "classification", ("random_forest",), **SIZES)
    p = F.col("anomaly_probability")
    found = stage(trained.predictions.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(p.isNull()).alias("missing"), F.count_if((p < 0) | (p > 1)).alias("outside")), "scores")
    trained.release()
    return snapped(found)


@query("ml9_train_evaluate", _fitted_sql(*ml.MODELS))
def _(spark, sf):
    return _fit(spark, sf, "regression", *ml.MODELS)


@query("ml10_model_persistence", with_ctes(
    f"SELECT count(*) AS row_count, 0::BIGINT AS mismatches FROM {_SPLIT_CTE} WHERE split = 'test'", "pos"))
def _(spark, sf):
    """The stored pipeline gives the predictions of the one in memory."""
    rows = dataset(spark, sf)
    trained = ml.train_and_evaluate(rows, TARGETS["regression"], "regression", ("random_forest",), **SIZES)
    paths = ml.save_models(trained.models, staging_path(spark, "models"), "regression", "all")
    again = ml.apply_saved(paths["random_forest"], rows, TARGETS["regression"], "regression").where("split = 'test'")
    keys = ["y_true", "y_pred"]
    live = trained.predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("live"))
    both = join_on(live, again.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored")), keys, "full")
    n, m = F.coalesce("live", F.lit(0)), F.coalesce("stored", F.lit(0))
    found = stage(both.agg(F.sum(m).alias("row_count"), F.sum(F.abs(n - m)).alias("mismatches")), "compared")
    trained.release()
    return snapped(found)


@query("ml11_metrics_table", with_ctes(
    f"SELECT scenario, model, split, row_count, {snap('mae')}, {snap('rmse')}, {snap('r2')} FROM met", "met"))
def _(spark, sf):
    return snapped(inputs.metrics(spark, sf))


# --- evaluation ------------------------------------------------------------

@query("e1_regression_metrics", with_ctes(f"""
 SELECT scenario, count(*) AS row_count, {snap('avg(abs(y_pred - y_true))', 'mae')},
  {snap('sqrt(avg((y_pred - y_true) * (y_pred - y_true)))', 'rmse')},
  {snap('1 - sum((y_pred - y_true) * (y_pred - y_true)) / (var_pop(y_true) * count(*))', 'r2')}
 FROM reg WHERE model = 'persistence' GROUP BY 1""", "reg"))
def _(spark, sf):
    rows = inputs.value_predictions(spark, sf).where("model = 'persistence'")
    return snapped(ev.regression_metrics(rows, ["scenario"]))


_CLASS_SQL = ", ".join([
    snap("avg(CAST(y_true = y_pred AS INTEGER))", "accuracy"),
    snap("coalesce(sum(y_true * y_pred) / nullif(sum(y_pred), 0)::DOUBLE, 0)", "precision"),
    snap("coalesce(sum(y_true * y_pred) / nullif(sum(y_true), 0)::DOUBLE, 0)", "recall"),
    snap("coalesce(2 * sum(y_true * y_pred) / nullif(sum(y_pred) + sum(y_true), 0)::DOUBLE, 0)", "f1"),
])


@query("e2_classification_metrics", with_ctes(f"SELECT prediction_file, {_CLASS_SQL} FROM cls GROUP BY 1", "cls"))
def _(spark, sf):
    rows, _ = inputs.class_predictions(spark, sf)
    return snapped(ev.classification_metrics(rows, ["prediction_file"]))


@query("e3_roc_auc", with_ctes(f"SELECT prediction_file, {snap('roc_auc')} FROM auc", "auc"))
def _(spark, sf):
    rows, layout = inputs.class_predictions(spark, sf)
    return snapped(ev.roc_auc(rows, ["prediction_file"], layout=layout))


@query("e3_roc_curve", with_ctes(f"""
 SELECT prediction_file, {snap('s', 'threshold')}, tp::BIGINT AS tp, fp::BIGINT AS fp, {snap('tp / ps', 'tpr')}, {snap('fp / ns', 'fpr')}
 FROM (SELECT *, sum(p) OVER down AS tp, sum(n) OVER down AS fp, lead(p) OVER down AS np, lead(n) OVER down AS nn,
   sum(p) OVER (PARTITION BY prediction_file) AS ps, sum(n) OVER (PARTITION BY prediction_file) AS ns
  FROM (SELECT prediction_file, anomaly_probability AS s, count(*) FILTER (y_true = 1) AS p, count(*) FILTER (y_true <> 1) AS n FROM cls GROUP BY 1, 2)
  WINDOW down AS (PARTITION BY prediction_file ORDER BY s DESC))
 WHERE np IS NULL OR p * nn <> n * np
 UNION ALL SELECT DISTINCT prediction_file, NULL, 0, 0, {snap('0', 'tpr')}, {snap('0', 'fpr')} FROM cls""", "cls"))
def _(spark, sf):
    rows, layout = inputs.class_predictions(spark, sf)
    return snapped(ev.roc_curve(rows, ["prediction_file"], layout=layout))


@query("ml9_feature_importance", with_ctes(f"""
 SELECT feature, {snap('avg(abs(c))', 'importance')}
 FROM (SELECT unnest(['cpu_total', 'memory_total', 'latency_service_count']) AS feature,
   unnest([2 * (coalesce(lead(cpu_total) OVER h, first_value(cpu_total) OVER h) - cpu_total),
    0.25 * (coalesce(lead(memory_total) OVER h, first_value(memory_total) OVER h) - memory_total), 0]) AS c
  FROM state WINDOW h AS (ORDER BY md5('42|' || sample_key || '|' || seq)))
 GROUP BY 1""", "state"))
def _(spark, sf):
    telemetry, _ = inputs.telemetry(spark, sf, stored=True)
    state = fill_state(system_state(telemetry, prep.ORDER))
    rows = state.withColumn("target", 2 * F.col("cpu_total") + 0.25 * F.col("memory_total"))
    linear = 2 * F.element_at("values", 1) + 0.25 * F.element_at("values", 2)
    found = permutation_importance(
        rows, ["cpu_total", "memory_total", "latency_service_count"], "target", ["sample_key", "seq"], lambda df: df.withColumn("y_pred", linear)
    )
    return snapped(found)


def class_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Class predictions written as one table for each event type, CSV and Parquet, and read back as a tree."""
    rows, _ = inputs.class_predictions(spark, sf)
    named = rows.select(
        F.lit("classification").alias("task"), F.col("prediction_file").alias("scenario"), F.lit("persistence").alias("model"), "step",
        "y_true", "y_pred", "anomaly_probability",
    )
    root = prediction_tree(spark, named, ["task", "scenario"], "scenario IN ('click', 'signup')")
    return src.load_predictions(spark, root).withColumn("prediction_file", F.col("scenario"))


@query("e4_evaluate_directory", with_ctes(
    f"SELECT prediction_file, {_CLASS_SQL}, {snap('max(auc.roc_auc)', 'roc_auc')} FROM cls JOIN auc USING (prediction_file) GROUP BY 1",
    "cls", "auc"))
def _(spark, sf):
    found = class_tree(spark, sf)
    return snapped(ev.evaluate_predictions(found, ["prediction_file"]))


@query("e5_positive_share", with_ctes(
    f"SELECT prediction_file, {snap('avg(y_true)', 'positive_share_train')} FROM cls GROUP BY 1", "cls"))
def _(spark, sf):
    rows, _ = inputs.class_predictions(spark, sf)
    return snapped(ev.positive_share(rows, ["prediction_file"], "y_true"))


@query("e6_confusion", with_ctes("""
 SELECT prediction_file, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
  count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn FROM cls GROUP BY 1""", "cls"))
def _(spark, sf):
    rows, _ = inputs.class_predictions(spark, sf)
    return ev.confusion(rows, ["prediction_file"])


# --- metric tables ---------------------------------------------------------

_MET = f"{snap('mae')}, {snap('rmse')}, {snap('r2')}"


@query("r1_flatten_metrics", with_ctes(f"SELECT 'regression' AS task, scenario, model, split, {_MET} FROM met", "met"))
def _(spark, sf):
    path = staging_path(spark, "documents")
    nested = ev.metrics_document(inputs.metrics(spark, sf), ["scenario"], ["mae", "rmse", "r2"])
    nested.select(F.lit("regression").alias("task"), "scenario", "models").write.json(path)
    stored = spark.read.schema(
        "task string, scenario string, models map<string, map<string, struct<mae: double, rmse: double, r2: double>>>"
    ).json(path)
    return snapped(ev.flatten_metrics(stored, ["task", "scenario"]))


@query("r2_prediction_summary", with_ctes(f"""
 SELECT prediction_file, count(*) AS rows, {snap('avg(y_pred - y_true)', 'mean_error')}, {snap('avg(abs(y_pred - y_true))', 'mean_abs_error')},
  {snap('avg(anomaly_probability)', 'mean_anomaly_probability')}, count(*) FILTER (anomaly_probability >= 0.8::DOUBLE) AS high_risk_count_0_8
 FROM cls GROUP BY 1""", "cls"))
def _(spark, sf):
    rows, _ = inputs.class_predictions(spark, sf)
    return snapped(ev.prediction_summary(rows, ["prediction_file"]))


@query("r2_prediction_tree", with_ctes(f"""
 SELECT 'classification' AS task, prediction_file, 'persistence' AS model, count(*) AS rows, {snap('avg(y_pred - y_true)', 'mean_error')}, {snap('avg(abs(y_pred - y_true))', 'mean_abs_error')},
  {snap('avg(anomaly_probability)', 'mean_anomaly_probability')}, count(*) FILTER (anomaly_probability >= 0.8::DOUBLE) AS high_risk_count_0_8
 FROM cls GROUP BY prediction_file""", "cls"))
def _(spark, sf):
    return snapped(ev.prediction_summary(class_tree(spark, sf), ["task", "prediction_file", "model"]))
