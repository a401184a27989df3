"""SQL building blocks (common table expressions) of the oracle queries."""

from __future__ import annotations

from perfwatch.operators.dynamics import DYNAMIC_SOURCES

FAMILIES = ["cpu", "memory", "net_rx", "net_tx"]

_TEL_COLUMNS = "\n".join(
    f""" coalesce(sum({f}), 0) AS {f}_total_raw, max({f}) AS {f}_max_raw, avg({f}) AS {f}_mean_raw,
 coalesce(stddev_samp({f}), 0) AS {f}_std_raw, count({f}) AS {f}_count_raw,"""
    for f in FAMILIES
)
_PRESENT = {f: "true" for f in FAMILIES} | {"net_tx": "sample_key <> 'signup'"}
_STATE_COLUMNS = "\n".join(
    f""" CASE WHEN {_PRESENT[f]} THEN {f}_total_raw END AS {f}_total, CASE WHEN {_PRESENT[f]} THEN {f}_max_raw END AS {f}_max,
 CASE WHEN {_PRESENT[f]} THEN {f}_mean_raw END AS {f}_mean, CASE WHEN {_PRESENT[f]} THEN {f}_std_raw END AS {f}_std,
 CASE WHEN {_PRESENT[f]} THEN {f}_count_raw END AS {f}_service_count, CASE WHEN {_PRESENT[f]} THEN 1 ELSE 0 END AS {f}_available,"""
    for f in FAMILIES
)
_RATIOS = "\n".join(
    f""" CASE WHEN {f}_total IS NULL THEN NULL WHEN {f}_total = 0 OR p95_latency IS NULL THEN 0
 ELSE p95_latency / ({f}_total + 1e-9::DOUBLE) END AS latency_to_{f}_ratio,"""
    for f in FAMILIES
)


def _needs(column: str) -> str:
    return _PRESENT["net_tx"] if column in ("net_tx_total", "net_total") else "true"


_DYNAMICS = ",\n".join(
    f""" CASE WHEN {_needs(c)} THEN coalesce({c} - lag({c}) OVER w, 0) END AS {c}_diff_1,
 CASE WHEN {_needs(c)} THEN coalesce({c} / nullif(lag({c}) OVER w, 0) - 1, 0) END AS {c}_pct_change_1,
 CASE WHEN {_needs(c)} THEN coalesce(avg({c}) OVER w3, 0) END AS {c}_rolling_mean_3,
 CASE WHEN {_needs(c)} THEN coalesce(stddev_samp({c}) OVER w3, 0) END AS {c}_rolling_std_3"""
    for c in DYNAMIC_SOURCES
)

CTES: dict[str, tuple[list[str], str]] = {
    "ev": ([], """
 SELECT event_id, ts, user_id, event_type, value, props, epoch_us(ts) AS us,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"""),
    "tel": (["ev"], """
 SELECT event_type AS sample_key, us // 21600000000 AS window_id, CAST(user_id % 4 AS INTEGER) AS service_id,
  avg(value) AS latency, min(us % 21600000000) / 1e6::DOUBLE AS start, sum(k) AS cpu, sum(value) AS memory,
  max(k) AS net_rx, CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS net_tx,
  max(value) AS peak
 FROM ev GROUP BY 1, 2, 3, event_type"""),
    "raw_state": (["tel"], f"""
 SELECT sample_key, window_id, CAST(max(peak) >= 100 AS INTEGER) AS label_trace,
  quantile_cont(latency, 0.5) AS p50_latency, quantile_cont(latency, 0.9) AS p90_latency,
  quantile_cont(latency, 0.95) AS p95_latency, avg(latency) AS mean_latency, max(latency) AS max_latency,
  min(latency) AS min_latency, coalesce(stddev_samp(latency), 0) AS std_latency,
  count(latency) AS latency_service_count,
  avg(start) AS mean_start, max(start) AS max_start, min(start) AS min_start,
  coalesce(stddev_samp(start), 0) AS std_start, max(start) - min(start) AS span_start,
{_TEL_COLUMNS}
  row_number() OVER (PARTITION BY sample_key ORDER BY window_id) - 1 AS seq
 FROM tel GROUP BY 1, 2"""),
    "masked": (["raw_state"], f"""
 SELECT sample_key, seq, window_id, label_trace, p50_latency, p90_latency, p95_latency, mean_latency, max_latency,
  min_latency, std_latency, latency_service_count, mean_start, max_start, min_start, std_start, span_start,
{_STATE_COLUMNS}
  count(*) OVER (PARTITION BY sample_key) AS n
 FROM raw_state"""),
    "state": (["masked"], f"""
 SELECT *,
{_RATIOS}
  coalesce(cpu_total, 0) + coalesce(memory_total, 0) AS resource_pressure,
  CASE WHEN net_tx_total IS NOT NULL THEN net_rx_total + net_tx_total END AS net_total
 FROM masked"""),
    "dyn": (["state"], f"""
 SELECT *,
{_DYNAMICS}
 FROM state
 WINDOW w AS (PARTITION BY sample_key ORDER BY seq),
  w3 AS (PARTITION BY sample_key ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "thr": (["state"], """
 SELECT sample_key, quantile_cont(p95_latency, 0.95) AS latency_threshold,
  quantile_cont(cpu_total, 0.95) AS cpu_threshold, quantile_cont(memory_total, 0.95) AS memory_threshold
 FROM state WHERE seq < greatest(1, floor(n::DOUBLE * 0.7::DOUBLE)) GROUP BY 1"""),
    "lab": (["dyn", "thr"], """
 SELECT dyn.*, CAST(p95_latency >= latency_threshold AS INTEGER) AS latency_anomaly,
  CAST(cpu_total >= cpu_threshold AS INTEGER) AS cpu_anomaly,
  CAST(memory_total >= memory_threshold AS INTEGER) AS memory_anomaly,
  CAST(p95_latency >= latency_threshold OR cpu_total >= cpu_threshold OR memory_total >= memory_threshold AS INTEGER)
   AS system_anomaly
 FROM dyn JOIN thr USING (sample_key)"""),
    "pos": (["lab"], """
 SELECT *, row_number() OVER (PARTITION BY sample_key ORDER BY window_id, seq) - 1 AS pos FROM lab"""),
    "preds": (["ev"], """
 SELECT * FROM (
  SELECT event_type, event_id, value, lead(value) OVER w AS next_value, row_number() OVER w - 1 AS pos,
   count(*) OVER (PARTITION BY event_type) AS n
  FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY event_id)) WHERE pos < n - 1"""),
    "cls": (["preds"], """
 SELECT event_type AS prediction_file, pos AS step, 'test' AS split, CAST(next_value >= 50 AS INTEGER) AS y_true,
  CAST(value >= 50 AS INTEGER) AS y_pred, least(1.0::DOUBLE, value / 200) AS anomaly_probability
 FROM preds"""),
    "auc": (["cls"], """
 SELECT prediction_file, (sum(CASE WHEN y_true = 1 THEN avg_rank END) - np * (np + 1) / 2.0::DOUBLE) / (np::DOUBLE * nn) AS roc_auc
 FROM (SELECT prediction_file, y_true,
   rank() OVER (PARTITION BY prediction_file ORDER BY anomaly_probability)
    + (count(*) OVER (PARTITION BY prediction_file, anomaly_probability) - 1) / 2.0::DOUBLE AS avg_rank,
   sum(y_true) OVER (PARTITION BY prediction_file) AS np, sum(1 - y_true) OVER (PARTITION BY prediction_file) AS nn
  FROM cls) GROUP BY prediction_file, np, nn"""),
    "reg": (["preds"], """
 SELECT event_type AS scenario, ['train','val','test'][1 + least(2, CAST(floor(pos * 3 / (n - 1)::DOUBLE) AS BIGINT))] AS split,
  pos AS step, next_value AS y_true, model,
  CASE model WHEN 'persistence' THEN value ELSE median END AS y_pred
 FROM preds JOIN (SELECT event_type, quantile_cont(value, 0.5) AS median FROM events GROUP BY 1) USING (event_type),
  (VALUES ('persistence'), ('median')) AS m(model)"""),
    "met": (["reg"], """
 SELECT scenario, model, split, count(*) AS row_count, avg(abs(y_pred - y_true)) AS mae,
  sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS rmse,
  1 - sum((y_pred - y_true) * (y_pred - y_true)) / (var_pop(y_true) * count(*)) AS r2
 FROM reg GROUP BY 1, 2, 3"""),
    "paths": ([], """
 SELECT DISTINCT '/data/predictive_processed_dataset/part_000' || (user_id % 3) || '/' || event_type || '/run_' || (user_id % 50) || '/'
  || ['train','val','test','metadata','predictive_p95_dataset','aggregated_system_state','marked_anomaly_state','aggregation_metadata'][1 + event_id % 8]
  || CASE WHEN event_id % 8 IN (3, 7) THEN '.json' ELSE '.parquet' END AS path
 FROM events"""),
    "idx": (["paths"], """
 SELECT path AS absolute_path, role AS file_role, rel AS relative_path_from_part, '/data/predictive_processed_dataset' AS predictive_root,
  split_part(rel, '/', 1) AS part_name, split_part(rel, '/', 2) AS scenario,
  regexp_replace(rel, '/[^/]*$', '') AS logical_sample_key, split_part(rel, '/', 4) AS file_name,
  '.' || split_part(rel, '.', 2) AS file_suffix, split_part(rel, '/', 3) AS parent_dir_name
 FROM (SELECT path, rel, CASE stem WHEN 'aggregated_system_state' THEN 'aggregated' WHEN 'marked_anomaly_state' THEN 'marked'
   WHEN 'predictive_p95_dataset' THEN 'predictive' WHEN 'aggregation_metadata' THEN NULL ELSE stem END AS role
  FROM (SELECT path, substr(path, 36) AS rel, split_part(split_part(path, '/', 7), '.', 1) AS stem FROM paths))
 WHERE role IS NOT NULL"""),
    "smp": (["idx"], """
 SELECT logical_sample_key, min(part_name) AS part_name, min(scenario) AS scenario, count(*) AS file_count,
  bool_or(file_role = 'predictive') AS has_predictive, bool_or(file_role = 'train') AS has_train,
  bool_or(file_role = 'val') AS has_val, bool_or(file_role = 'test') AS has_test,
  bool_or(file_role = 'metadata') AS has_metadata,
  bool_or(file_role = 'train') AND bool_or(file_role = 'val') AND bool_or(file_role = 'test') AS is_complete_for_training
 FROM idx GROUP BY 1"""),
    "rol": (["idx"], """
 SELECT file_role, file_suffix, count(*) AS file_count FROM idx GROUP BY 1, 2"""),
    "edges": ([], """
 SELECT DISTINCT o_orderpriority AS scenario, a.n_name || '_' || b.n_name AS source_operation, a.n_name AS source_service,
  b.n_name AS target_service
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey"""),
    "place": ([], """
 SELECT n_name AS service, r_name AS node FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 0"""),
    "mon0": (["ev"], """
 SELECT event_type AS scenario, us // 21600000000 AS window_id, 'svc-' || (user_id % 8) AS service,
  avg(value) AS mean_latency, sum(k) AS cpu_total, sum(value) AS memory_total, CAST(count(*) AS DOUBLE) AS net_total,
  quantile_cont(value, 0.95) AS p95_latency, quantile_cont(value, 0.90) AS p90_latency,
  us // 21600000000 - (SELECT min(us) // 21600000000 FROM ev) AS step, sum(k) + sum(value) AS resource_pressure
 FROM ev GROUP BY 1, 2, 3"""),
    "mon": (["mon0"], """
 SELECT mon0.*, CAST(p95_latency >= lim AS INTEGER) AS system_anomaly
 FROM mon0 JOIN (SELECT scenario, quantile_cont(p95_latency, 0.95) AS lim FROM mon0
  JOIN (SELECT scenario, max(step) + 1 AS steps FROM mon0 GROUP BY 1) USING (scenario)
  WHERE step < floor(steps::DOUBLE * 0.7::DOUBLE) GROUP BY 1) USING (scenario)"""),
    "svc": (["ev"], """
 SELECT event_type AS scenario, us // 21600000000 AS window_id, n_name AS service, avg(value) AS mean_latency,
  sum(k) AS cpu_total, sum(value) AS memory_total, CAST(count(*) AS DOUBLE) AS net_total,
  quantile_cont(value, 0.95) AS p95_latency, quantile_cont(value, 0.90) AS p90_latency,
  us // 21600000000 - (SELECT min(us) // 21600000000 FROM ev) AS step
 FROM ev JOIN nation ON n_nationkey = user_id % 20 GROUP BY 1, 2, 3"""),
    "smon": (["svc"], """
 SELECT svc.*, CAST(p95_latency >= lim AS INTEGER) AS system_anomaly
 FROM svc JOIN (SELECT scenario, quantile_cont(p95_latency, 0.95) AS lim FROM svc
  JOIN (SELECT scenario, max(step) + 1 AS steps FROM svc GROUP BY 1) USING (scenario)
  WHERE step < floor(steps::DOUBLE * 0.7::DOUBLE) GROUP BY 1) USING (scenario)"""),
    "inc": (["mon"], """
 SELECT *, CASE WHEN lo = hi THEN 'Высокая' WHEN p95_latency <= lo + (hi - lo) / 3.0::DOUBLE THEN 'Средняя'
  WHEN p95_latency <= lo + (hi - lo) / 3.0::DOUBLE * 2 THEN 'Высокая' ELSE 'Критическая' END AS severity
 FROM (SELECT *, min(p95_latency) OVER () AS lo, max(p95_latency) OVER () AS hi,
   row_number() OVER (ORDER BY step, service, scenario) - 1 AS place
  FROM (SELECT * FROM mon WHERE system_anomaly = 1 ORDER BY step DESC, service DESC, scenario DESC LIMIT 80))"""),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` behind the named expressions and those they build on."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in needed) + "\n" + body
