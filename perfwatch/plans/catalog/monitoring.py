"""Queries of the monitoring reports, filters and service graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.functions.scalars import mapped
from perfwatch.operators import health
from perfwatch.operators import manifest as mf
from perfwatch.operators import reports as rep
from perfwatch.operators import services as svc
from perfwatch.plans import inputs
from perfwatch.plans.catalog.files import prediction_tree
from perfwatch.plans.catalog.registry import query, snap, snapped
from perfwatch.plans.catalog.sql import with_ctes
from perfwatch.sources import files as src

MODELS = {"persistence": "Persistence forecast", "median": "Median forecast"}
_LABEL = "CASE model WHEN 'persistence' THEN 'Persistence forecast' WHEN 'median' THEN 'Median forecast' ELSE model END"


def nation_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Panel telemetry whose services are nations, as in the service graph."""
    names = inputs.table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("service"))
    return inputs.monitored(spark, sf, by_nation=names)


# --- trees and steps -------------------------------------------------------

@query("s11_prediction_trees", with_ctes(
    f"SELECT scenario, model, step, {snap('y_true')}, {snap('y_pred')}, 1::BIGINT AS skipped_files FROM reg", "reg"))
def _(spark, sf):
    rows = inputs.value_predictions(spark, sf).select("scenario", "model", "step", "y_true", "y_pred")
    root = prediction_tree(spark, rows, ["scenario"], "scenario IN ('click', 'view') OR model = 'median'")
    found, skipped = src.load_prediction_tree(spark, root)
    return snapped(found.select("scenario", "model", "step", "y_true", "y_pred")).withColumn(
        "skipped_files", skipped.agg(F.count(F.lit(1))).scalar())


@query("w10_running_step", with_ctes(
    "SELECT sample_key, seq, row_number() OVER (ORDER BY sample_key, seq) - 1 AS step, 'system' AS service, 'all' AS scenario FROM state", "state"))
def _(spark, sf):
    telemetry, _ = inputs.telemetry(spark, sf)
    return src.panel_telemetry(telemetry.select("sample_key", "seq"), ["sample_key", "seq"])


@query("w11_last_rows_mean", with_ctes(f"""
 SELECT service, {snap('avg(p95_latency)', 'recent_p95_latency')}
 FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY step DESC, scenario DESC) AS r FROM mon) WHERE r <= 20 GROUP BY 1""", "mon"))
def _(spark, sf):
    return snapped(svc.last_mean(inputs.monitored(spark, sf), ["service"], ["step", "scenario"], "p95_latency", 20))


@query("w12_last_value", with_ctes(f"SELECT scenario, model, {snap('arg_max(y_pred, step)', 'last_pred')} FROM reg GROUP BY 1, 2", "reg"))
def _(spark, sf):
    return snapped(inputs.value_predictions(spark, sf).groupBy("scenario", "model").agg(F.max_by("y_pred", "step").alias("last_pred")))


@query("w13_forecast_shift", with_ctes(f"""
 SELECT scenario, step + 1 AS step, {snap('y_pred')}, {snap('y_pred', 'y_pred_display')}
 FROM (SELECT * FROM reg WHERE model = 'persistence' ORDER BY step DESC, scenario DESC LIMIT 220)""", "reg"))
def _(spark, sf):
    return snapped(rep.forecast_series(inputs.value_predictions(spark, sf), "all", "persistence"))


# --- filters ---------------------------------------------------------------

_PANEL = f"scenario, step, service, {snap('p95_latency')}"


@query("p12_scenario_filter", with_ctes(f"SELECT {_PANEL} FROM mon WHERE scenario = 'click'", "mon"))
def _(spark, sf):
    return snapped(rep.filter_scenario(inputs.monitored(spark, sf), "click").select("scenario", "step", "service", "p95_latency"))


@query("p13_service_filter", with_ctes(f"SELECT {_PANEL} FROM mon WHERE service IN ('svc-1', 'svc-3')", "mon"))
def _(spark, sf):
    return snapped(rep.filter_services(inputs.monitored(spark, sf), ["svc-1", "svc-3"]).select("scenario", "step", "service", "p95_latency"))


@query("p14_period_filter", with_ctes(f"SELECT {_PANEL} FROM mon WHERE step >= (SELECT max(step) FROM mon) - 12 + 1", "mon"))
def _(spark, sf):
    return snapped(rep.filter_period(inputs.monitored(spark, sf), 12).select("scenario", "step", "service", "p95_latency"))


@query("p15_label_mapping", with_ctes(f"SELECT scenario, split, {_LABEL} AS model_name, {snap('rmse')} FROM met", "met"))
def _(spark, sf):
    return snapped(inputs.metrics(spark, sf).select("scenario", "split", mapped(F.col("model"), MODELS).alias("model_name"), "rmse"))


@query("p16_event_time", with_ctes("""
 SELECT scenario, step, service, strftime(make_timestamp(1744272000000000 + step * 300000000), '%Y-%m-%d %H:%M:%S') AS event_time FROM mon""", "mon"))
def _(spark, sf):
    timed = rep.with_event_time(inputs.monitored(spark, sf))
    return timed.select("scenario", "step", "service", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))


# --- graph, joins, sets ----------------------------------------------------

@query("u1_service_union", with_ctes(
    "SELECT service FROM smon UNION SELECT source_service FROM edges UNION SELECT target_service FROM edges", "smon", "edges"))
def _(spark, sf):
    return svc.services_of(inputs.service_edges(spark, sf), nation_telemetry(spark, sf))


_DEGREES = """(SELECT service, CAST(sum(o) AS BIGINT) AS rpc_out, CAST(sum(i) AS BIGINT) AS rpc_in FROM (
 SELECT source_service AS service, 1 AS o, 0 AS i FROM edges UNION ALL SELECT target_service, 0, 1 FROM edges) GROUP BY 1)"""


@query("j2_placement_lookup", with_ctes(
    "SELECT e.service, coalesce(node, '-') AS node FROM (SELECT DISTINCT source_service AS service FROM edges) e LEFT JOIN place USING (service)",
    "edges", "place"))
def _(spark, sf):
    services = inputs.service_edges(spark, sf).select(F.col("source_service").alias("service")).distinct()
    return svc.with_placement(services, inputs.placement(spark, sf))


_RECENT = """(SELECT service, avg(system_anomaly) * 100 AS risk_share, avg(p95_latency) FILTER (r <= 20) AS recent_p95_latency
 FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY step DESC, scenario DESC) AS r FROM smon) GROUP BY 1)"""


@query("j3_service_telemetry", with_ctes(f"""
 SELECT d.service, rpc_out, rpc_in, {snap('risk_share')}, {snap('recent_p95_latency')} FROM {_DEGREES} d LEFT JOIN {_RECENT} USING (service)""",
    "edges", "smon"))
def _(spark, sf):
    graph = svc.degrees(inputs.service_edges(spark, sf))
    recent = svc.telemetry_by_service(nation_telemetry(spark, sf), ["step", "scenario"])
    return snapped(graph.join(recent, "service", "left"))


@query("r13_graph_degree", with_ctes(f"SELECT * FROM {_DEGREES}", "edges"))
def _(spark, sf):
    return svc.degrees(inputs.service_edges(spark, sf))


_RISK = "greatest(0, least(100, 18 + 6 * rpc_in + 4 * rpc_out + 0.35::DOUBLE * coalesce(risk_share, 0)))"
_SUMMARY = f"""(SELECT d.service, coalesce(node, '-') AS node, rpc_in, rpc_out, CAST({_RISK} AS DOUBLE) AS risk_score,
  coalesce(recent_p95_latency, 95000 + 4200 * {_RISK}) AS p95_latency
 FROM {_DEGREES} d LEFT JOIN place USING (service) LEFT JOIN {_RECENT} USING (service))"""


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return svc.service_summary(
        nation_telemetry(spark, sf), inputs.service_edges(spark, sf), inputs.placement(spark, sf), rounded=False
    )


@query("r14_service_risk", with_ctes(
    f"SELECT service, node, rpc_in, rpc_out, {snap('risk_score')} FROM {_SUMMARY}", "edges", "place", "smon"))
def _(spark, sf):
    return snapped(_summary(spark, sf).drop("p95_latency"))


@query("r15_service_p95", with_ctes(f"SELECT service, {snap('p95_latency')} FROM {_SUMMARY}", "edges", "place", "smon"))
def _(spark, sf):
    return snapped(_summary(spark, sf).select("service", "p95_latency"))


@query("o2_top_k", with_ctes(f"SELECT {_PANEL} FROM mon ORDER BY mon.p95_latency DESC, scenario, step, service LIMIT 20", "mon"))
def _(spark, sf):
    rows = inputs.monitored(spark, sf).orderBy(F.desc("p95_latency"), "scenario", "step", "service").limit(20)
    return snapped(rows.select("scenario", "step", "service", "p95_latency"))


@query("o3_tail_k", with_ctes(f"SELECT {_PANEL} FROM mon ORDER BY step DESC, scenario DESC, service DESC LIMIT 80", "mon"))
def _(spark, sf):
    rows = rep.last_rows(inputs.monitored(spark, sf), 80, ["step", "scenario", "service"])
    return snapped(rows.select("scenario", "step", "service", "p95_latency"))


# --- reports ---------------------------------------------------------------

@query("r3_best_model", with_ctes(
    "SELECT coalesce(arg_min(model, (rmse, mae, model)), 'hist_gradient_boosting') AS best_model FROM met WHERE split = 'test' AND scenario = 'click'", "met"))
def _(spark, sf):
    return rep.best_model(inputs.metrics(spark, sf), "click")


_MET = f"{snap('mae')}, {snap('rmse')}, {snap('r2')}"


@query("r4_model_quality", with_ctes(f"SELECT scenario, model AS model_name, split, {_MET} FROM met WHERE scenario = 'view'", "met"))
def _(spark, sf):
    return snapped(rep.model_quality(inputs.metrics(spark, sf), "view"))


@query("r5_test_comparison", with_ctes(f"SELECT scenario, model, model AS model_label, {_MET} FROM met WHERE split = 'test'", "met"))
def _(spark, sf):
    return snapped(rep.test_comparison(inputs.metrics(spark, sf)))


_RISK_COLUMNS = f"scenario, step, window_id, service, {snap('p95_latency')}, {snap('cpu_total')}, {snap('memory_total')}, {snap('net_total')}"


@query("r6_risk_windows", with_ctes(
    f"SELECT {_RISK_COLUMNS} FROM mon WHERE p95_latency >= (SELECT quantile_cont(p95_latency, 0.95) FROM mon)", "mon"))
def _(spark, sf):
    return snapped(rep.risk_windows(inputs.monitored(spark, sf).drop("system_anomaly")))


@query("r6_risk_windows_flagged", with_ctes(
    f"SELECT {_RISK_COLUMNS}, 1::BIGINT AS system_anomaly FROM mon WHERE system_anomaly = 1 AND service IN ('svc-0', 'svc-5')", "mon"))
def _(spark, sf):
    return snapped(rep.risk_windows(inputs.monitored(spark, sf), services=["svc-0", "svc-5"]))


@query("r7_kpi_row", with_ctes(f"""
 SELECT 'persistence' AS model, (SELECT count(DISTINCT service) FROM mon) AS service_count, count(DISTINCT step) AS windows,
  {snap('avg(system_anomaly) * 100', 'risk_share')},
  {snap("(SELECT y_pred FROM reg WHERE model = 'persistence' ORDER BY scenario DESC, step DESC LIMIT 1)", 'forecast_p95')},
  {snap("(SELECT rmse FROM met WHERE model = 'persistence' AND split = 'test' ORDER BY scenario LIMIT 1)", 'rmse')},
  {snap("(SELECT r2 FROM met WHERE model = 'persistence' AND split = 'test' ORDER BY scenario LIMIT 1)", 'r2')}
 FROM mon""", "mon", "met"))
def _(spark, sf):
    panel = inputs.monitored(spark, sf)
    return snapped(rep.kpi_row(
        panel, inputs.value_predictions(spark, sf), inputs.metrics(spark, sf),
        panel.select("service").distinct(), "all", "persistence"))


_SERIES = "(SELECT step, avg(p95_latency) AS p95_latency, avg(cpu_total) AS cpu_total FROM mon WHERE scenario = 'view' GROUP BY 1 ORDER BY 1 DESC LIMIT 100)"


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return rep.realtime_series(rep.filter_scenario(inputs.monitored(spark, sf), "view"), ["p95_latency", "cpu_total"], 100)


@query("r8_realtime_series", with_ctes(f"SELECT step, {snap('p95_latency')}, {snap('cpu_total')} FROM {_SERIES}", "mon"))
def _(spark, sf):
    return snapped(_series(spark, sf))


_SCALED = ", ".join(
    snap(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())", c) for c in ("p95_latency", "cpu_total"))


@query("r9_min_max_scaling", with_ctes(f"SELECT step, {_SCALED} FROM {_SERIES}", "mon"))
def _(spark, sf):
    return snapped(rep.min_max_scaled(_series(spark, sf), ["p95_latency", "cpu_total"]))


_FORECAST = """(SELECT scenario, step + 1 AS step, y_pred,
  (y_pred - (SELECT min(p95_latency) FROM mon WHERE scenario = 'view')) / (SELECT max(p95_latency) - min(p95_latency) FROM mon WHERE scenario = 'view') AS shown
 FROM (SELECT * FROM reg WHERE model = 'median' AND scenario = 'view' ORDER BY step DESC LIMIT 220))"""


def _forecast(spark: SparkSession, sf: str) -> DataFrame:
    raw = rep.filter_scenario(inputs.monitored(spark, sf), "view")
    return rep.forecast_series(inputs.value_predictions(spark, sf), "view", "median", raw)


@query("r10_forecast_scaling", with_ctes(
    f"SELECT scenario, step, {snap('y_pred')}, {snap('shown', 'y_pred_display')} FROM {_FORECAST}", "mon", "reg"))
def _(spark, sf):
    return snapped(_forecast(spark, sf))


@query("j4_series_forecast_join", with_ctes(
    f"SELECT step, {snap('p95_latency')}, {snap('cpu_total')}, {snap('shown', 'y_pred_display')} FROM {_SERIES} FULL JOIN {_FORECAST} USING (step)",
    "mon", "reg"))
def _(spark, sf):
    return snapped(rep.realtime_with_forecast(_series(spark, sf), _forecast(spark, sf)))


@query("r11_scale_by_maximum", with_ctes(
    "SELECT step, scenario, service, " + ", ".join(
        snap(f"{c} / max({c}) OVER ()", c) for c in ("p95_latency", "cpu_total", "memory_total", "net_total"))
    + " FROM (SELECT * FROM mon ORDER BY step DESC, scenario DESC, service DESC LIMIT 800)", "mon"))
def _(spark, sf):
    return snapped(rep.scaled_by_maximum(
        inputs.monitored(spark, sf), ["p95_latency", "cpu_total", "memory_total", "net_total"], ["step", "scenario", "service"]))


@query("r12_forecast_vs_actual", with_ctes(
    f"SELECT scenario, step, {snap('y_true')}, {snap('y_pred')} FROM reg WHERE model = 'persistence' ORDER BY scenario DESC, reg.step DESC LIMIT 600", "reg"))
def _(spark, sf):
    return snapped(rep.forecast_vs_actual(inputs.value_predictions(spark, sf), "all", "persistence"))


_STATUS4 = "['Передано в отчет', 'Проверяется', 'Под наблюдением', 'Проверяется'][1 + place % 4]"


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return rep.report_data(inputs.monitored(spark, sf))


@query("r16_incident_log", with_ctes(
    f"SELECT scenario, step, window_id, service, {snap('p95_latency')}, severity, {_STATUS4} AS status FROM inc", "inc"))
def _(spark, sf):
    return snapped(_log(spark, sf).select("scenario", "step", "window_id", "service", "p95_latency", "severity", "status"))


@query("r16_incident_table_fallback", with_ctes(
    f"SELECT scenario, step, service, {snap('p95_latency')} FROM (SELECT * FROM mon ORDER BY mon.p95_latency DESC LIMIT 8)", "mon"))
def _(spark, sf):
    quiet = inputs.monitored(spark, sf).withColumn("system_anomaly", F.lit(0))
    rows = rep.incidents(quiet, ["scenario", "step", "service"], 8, 20, rep.TABLE_STATUSES)
    return snapped(rows.select("scenario", "step", "service", "p95_latency"))


@query("r17_severity_bins", with_ctes("SELECT severity, count(*) AS count FROM inc GROUP BY 1", "inc"))
def _(spark, sf):
    return rep.status_counts(_log(spark, sf), "severity")


@query("r18_round_robin_status", with_ctes("""
 SELECT scenario, step, service, ['Передано в отчет', 'Проверяется', 'Проверяется'][1 + (row_number() OVER (ORDER BY scenario, step, service) - 1) % 3] AS status
 FROM (SELECT * FROM mon WHERE system_anomaly = 1 ORDER BY scenario DESC, step DESC, service DESC LIMIT 20)""", "mon"))
def _(spark, sf):
    rows = rep.incidents(inputs.monitored(spark, sf), ["scenario", "step", "service"], 8, 20, rep.TABLE_STATUSES)
    return rows.select("scenario", "step", "service", "status")


@query("r19_report_data", with_ctes(f"""
 SELECT scenario, step, service, {snap('p95_latency')} FROM (SELECT *, min(p95_latency) OVER () AS lo, max(p95_latency) OVER () AS hi FROM (
  SELECT * FROM mon WHERE scenario = 'error' AND step >= (SELECT max(step) FROM mon WHERE scenario = 'error') - 72 + 1
   AND service IN ('svc-0', 'svc-1', 'svc-2', 'svc-3') AND system_anomaly = 1 ORDER BY step DESC, service DESC LIMIT 80))
 WHERE lo <> hi AND p95_latency > lo + (hi - lo) / 3.0::DOUBLE * 2""", "mon"))
def _(spark, sf):
    log = rep.report_data(inputs.monitored(spark, sf), "error", 72, ["svc-0", "svc-1", "svc-2", "svc-3"], only_critical=True)
    return snapped(log.select("scenario", "step", "service", "p95_latency"))


@query("r20_operational_summary", with_ctes(f"""
 SELECT 'Все наблюдения' AS period, count(*) AS event_count, count(*) FILTER (severity = 'Критическая') AS critical_count,
  {snap("avg(CAST(severity = 'Критическая' AS INTEGER)) * 100", 'critical_share')}, {snap('avg(p95_latency)', 'mean_p95')},
  arg_max(service, (p95_latency, service)) AS peak_service, 8::BIGINT AS service_count FROM inc""", "inc"))
def _(spark, sf):
    return snapped(rep.operational_summary(_log(spark, sf), "Все наблюдения", 8))


@query("r21_incident_trend", with_ctes("""
 SELECT time_bucket, s AS severity, count(severity) AS events
 FROM (SELECT DISTINCT strftime(make_timestamp(1744272000000000 + step * 300000000), '%H:%M') AS time_bucket FROM inc)
  CROSS JOIN (VALUES ('Средняя'), ('Высокая'), ('Критическая')) v(s)
  LEFT JOIN inc ON strftime(make_timestamp(1744272000000000 + step * 300000000), '%H:%M') = time_bucket AND severity = s GROUP BY 1, 2""", "inc"))
def _(spark, sf):
    return rep.incident_trend(_log(spark, sf))


@query("r22_service_peaks", with_ctes(
    f"SELECT service, {snap('peak', 'p95_latency')} FROM (SELECT service, max(p95_latency) AS peak FROM inc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)", "inc"))
def _(spark, sf):
    return snapped(rep.service_peaks(_log(spark, sf)))


@query("r23_status_counts", with_ctes(f"SELECT {_STATUS4} AS status, count(*) AS count FROM inc GROUP BY 1", "inc"))
def _(spark, sf):
    return rep.status_counts(_log(spark, sf))


@query("r24_source_health", with_ctes("""
 SELECT sample_key, rule, CASE WHEN bad THEN bad_state ELSE 'Норма' END AS state FROM (
  SELECT r.sample_key, unnest(['cpu_missing','memory_missing','net_rx_missing','net_tx_missing','too_few_rows','unreadable_file','not_in_manifest','error_growth']) AS rule,
   unnest([false, false, false, r.sample_key LIKE 'signup%', n < 35, false, NOT coalesce(is_complete_for_training, true), test_rmse > val_rmse * 1.5::DOUBLE]) AS bad,
   unnest(['Деградация','Деградация','Деградация','Деградация','Ошибка','Ошибка','Ошибка','Требует анализа']) AS bad_state
  FROM (SELECT event_type || '/run_' || (user_id % 50) AS sample_key, event_type, count(DISTINCT us // 21600000000) AS n FROM ev GROUP BY 1, 2) r
  LEFT JOIN (SELECT substr(logical_sample_key, 11) AS sample_key, bool_and(is_complete_for_training) AS is_complete_for_training FROM smp GROUP BY 1) USING (sample_key)
  LEFT JOIN (SELECT scenario AS event_type, max(CASE WHEN split = 'val' THEN rmse END) AS val_rmse, max(CASE WHEN split = 'test' THEN rmse END) AS test_rmse
   FROM met WHERE model = 'persistence' GROUP BY 1) USING (event_type))""", "ev", "smp", "met"))
def _(spark, sf):
    telemetry = inputs.telemetry_wide(spark, sf, sample=inputs.by_run())
    sizes = telemetry.groupBy("sample_key").agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(f"{f}_available").alias(f"{f}_available") for f in ("cpu", "memory", "net_rx", "net_tx")])
    complete = mf.samples_index(mf.files_index(inputs.file_paths(spark, sf))).groupBy(
        F.expr("substring_index(logical_sample_key, '/', -2)").alias("sample_key")
    ).agg(F.bool_and("is_complete_for_training").alias("is_complete"))
    errors = inputs.metrics(spark, sf).where("model = 'persistence'").groupBy(F.col("scenario").alias("event_type")).agg(
        F.max(F.when(F.col("split") == "val", F.col("rmse"))).alias("val_rmse"),
        F.max(F.when(F.col("split") == "test", F.col("rmse"))).alias("test_rmse"))
    samples = (
        sizes.join(complete, "sample_key", "left")
        .withColumn("event_type", F.split("sample_key", "/")[0]).join(errors, "event_type", "left")
        .withColumn("is_readable", F.lit(True))
    )
    return health.source_health(samples, 35)

