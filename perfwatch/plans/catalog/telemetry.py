"""Queries of scans, families, state, dynamics, labels and the predictive dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.functions.scalars import finite
from perfwatch.operators import columns as cols
from perfwatch.operators import families as fam
from perfwatch.operators import labels as lab
from perfwatch.operators import predictive as pre
from perfwatch.operators.dynamics import DYNAMIC_SOURCES
from perfwatch.operators.ordering import Layout, fits_task
from perfwatch.operators.state import (
    RATIO_COLUMNS, START_COLUMNS, fill_state, state_columns, state_from_long, system_state,
)
from perfwatch.operators.validation import run_totals
from perfwatch.plans import inputs
from perfwatch.plans import preprocessing as prep
from perfwatch.plans.catalog.registry import query, snap, snapped
from perfwatch.plans.catalog.sql import with_ctes
from perfwatch.sources.tables import capped, sampled, unite

IDS = ["sample_key", "seq", "window_id"]
RESOURCES = list(fam.RESOURCE_FAMILIES)


def _snaps(names: list[str]) -> str:
    return ", ".join(snap(n) for n in names)


def _wide_sql(filter_: str = "") -> str:
    """Wide telemetry as SQL: conditional aggregates over the long form."""
    parts = []
    for s in range(inputs.SERVICES):
        for column, suffix in [
            ("latency", "latency"), ("start", "start"), ("cpu", "container_cpu_usage_seconds_total"),
            ("memory", "container_memory_usage_bytes"), ("net_rx", "container_network_receive_bytes_total"),
            ("net_tx", "container_network_transmit_bytes_total"),
        ]:
            parts.append(snap(f"max(CASE WHEN service_id = {s} THEN {column} END)", f'"{s}_{suffix}"'))
    return f"SELECT sample_key, window_id, {', '.join(parts)} FROM tel {filter_} GROUP BY 1, 2"


def _state(spark: SparkSession, sf: str) -> DataFrame:
    telemetry, _ = inputs.telemetry(spark, sf)
    return fill_state(system_state(telemetry, ("sample_key", "seq", "n")))


def _dynamics(spark: SparkSession, sf: str) -> DataFrame:
    telemetry, layout = inputs.telemetry(spark, sf)
    return prep.aggregated(telemetry, layout)


# --- scans -----------------------------------------------------------------

@query("s4_parquet_scan", "SELECT event_id, event_type, value FROM events WHERE value >= 50")
def _(spark, sf):
    return inputs.table(spark, sf, "events").where("value >= 50").select("event_id", "event_type", "value")


@query("s8_union_by_name", with_ctes(
    _wide_sql().replace("SELECT sample_key,", "SELECT sample_key, CASE WHEN sample_key = 'signup' THEN 'signup.csv' ELSE 'other.csv' END AS dataset_source_path,").replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3"),
    "tel"))
def _(spark, sf):
    wide = inputs.telemetry_wide(spark, sf).drop(*[f"{f}_available" for f in fam.family_columns(inputs.telemetry_wide(spark, sf))], "label_trace")
    lacking = fam.token_columns(wide, fam.RESOURCE_FAMILIES["net_tx"])
    own = wide.where("sample_key = 'signup'").drop(*lacking)
    return snapped(unite({"other.csv": wide.where("sample_key <> 'signup'"), "signup.csv": own}))


@query("s9_row_cap", with_ctes("SELECT sample_key, seq, window_id FROM state WHERE seq BETWEEN 0 AND 49", "state"))
def _(spark, sf):
    return capped(_state(spark, sf), 50).select(*IDS)


@query("s10_seeded_sample", with_ctes("""
 SELECT sample_key, seq FROM (SELECT sample_key, seq, n,
  row_number() OVER (PARTITION BY sample_key ORDER BY md5('42|' || sample_key || '|' || seq), seq) - 1 AS draw FROM state)
 WHERE n <= 1 OR draw < round_even(0.1::DOUBLE * n, 0)""", "state"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf)
    return sampled(telemetry.select("sample_key", "seq", "n"), layout, 0.10, 42).select("sample_key", "seq")


@query("s13_row_order", with_ctes("SELECT sample_key, window_id, seq, n FROM state", "state"))
def _(spark, sf):
    return inputs.telemetry(spark, sf)[0].select("sample_key", "window_id", "seq", "n")


# --- families and columns --------------------------------------------------

def _column_totals(wide: DataFrame, names: list[str]) -> DataFrame:
    values = wide.select(*names).unpivot([], names, "column_name", "value")
    return snapped(values.groupBy("column_name").agg(F.count("value").alias("cells"), F.sum("value").alias("total")))


def _totals_sql(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT service_id || '_{suffix}' AS column_name, count({c}) AS cells, {snap(f'sum({c})', 'total')} FROM tel GROUP BY 1"
        for c, suffix in pairs
    )


@query("p1_family_exact", with_ctes(_totals_sql([("latency", "latency"), ("start", "start")]), "tel"))
def _(spark, sf):
    wide = inputs.telemetry_wide(spark, sf)
    return _column_totals(wide, fam.exact_columns(wide, "latency") + fam.exact_columns(wide, "start"))


@query("p2_family_token", with_ctes(_totals_sql([
    ("cpu", "container_cpu_usage_seconds_total"), ("memory", "container_memory_usage_bytes"),
    ("net_rx", "container_network_receive_bytes_total"), ("net_tx", "container_network_transmit_bytes_total")]), "tel"))
def _(spark, sf):
    wide = inputs.telemetry_wide(spark, sf)
    return _column_totals(wide, [c for t in fam.RESOURCE_FAMILIES.values() for c in fam.token_columns(wide, t)])


@query("p3_numeric_coercion", with_ctes(
    "SELECT event_id, CASE WHEN k % 10 IN (0, 1, 2) THEN NULL ELSE value END AS number FROM ev", "ev"))
def _(spark, sf):
    kind = F.col("k") % 10
    raw = (
        F.when(kind == 0, F.lit("junk")).when(kind == 1, F.lit("Infinity")).when(kind == 2, F.lit("NaN"))
        .otherwise(F.col("value").cast("string"))
    )
    return inputs.events(spark, sf).select("event_id", finite(raw).alias("number"))


@query("p4_wide_to_long", with_ctes(" UNION ALL ".join(
    f"SELECT sample_key, window_id, CAST(service_id AS BIGINT) AS service_id, '{f}' AS family, {snap(f, 'value')} FROM tel WHERE {f} IS NOT NULL"
    for f in ["latency", "start", *RESOURCES]), "tel"))
def _(spark, sf):
    return snapped(fam.to_long(inputs.telemetry_wide(spark, sf), ["sample_key", "window_id"]))


@query("p5_passthrough_ids", with_ctes("SELECT sample_key, seq, window_id, CAST(label_trace AS BIGINT) AS label_trace FROM state", "state"))
def _(spark, sf):
    return snapped(_state(spark, sf).select(*IDS, "label_trace"))


@query("p6_source_lineage", with_ctes("""
 SELECT split_part(rel, '/', 4) AS source_file, rel AS source_relpath, split_part(rel, '/', 1) AS source_level_1,
  split_part(rel, '/', 2) AS source_level_2, split_part(rel, '/', 3) AS source_level_3
 FROM (SELECT substr(path, 36) AS rel FROM paths)""", "paths"))
def _(spark, sf):
    relative = F.expr(f"substring(path, {len(inputs.ROOT) + 2})")
    parts = fam.lineage(relative)
    return inputs.file_paths(spark, sf).select(*[c.alias(n) for n, c in parts.items()])


@query("p7_drop_select", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    orders = cols.drop_existing(inputs.table(spark, sf, "orders"), ["o_custkey", "no_such_column"])
    return cols.select_existing(orders, ["o_orderkey", "also_missing", "o_totalprice"])


@query("p8_numeric_columns", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(spark, sf):
    orders = inputs.table(spark, sf, "orders").drop("o_custkey")
    return cols.numeric_only(orders, ["o_orderstatus"])


@query("p9_features_target")
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    flat = pre.flatten_lags(prep.predictive(telemetry, layout))
    return cols.features_and_target(flat, "target_p95_latency_t_plus_1")


@query("p10_align_columns", with_ctes(f"""
 SELECT seq, {snap('p95_latency')}, 0::BIGINT AS not_in_this_split FROM state""", "state"))
def _(spark, sf):
    return snapped(cols.align(_state(spark, sf), ["seq", "p95_latency", "not_in_this_split"]))


@query("p11_fill_non_finite", with_ctes(f"""
 SELECT sample_key, seq, {_snaps(['net_tx_total', 'net_tx_max', 'net_total', 'latency_to_net_tx_ratio', 'p95_latency', 'cpu_max'])} FROM state""", "state"))
def _(spark, sf):
    return snapped(_state(spark, sf).select(
        "sample_key", "seq", "net_tx_total", "net_tx_max", "net_total", "latency_to_net_tx_ratio", "p95_latency", "cpu_max"))


# --- row-wise aggregation --------------------------------------------------

def _state_query(name: str, doubles: list[str], integers: list[str] = []) -> None:
    body = f"SELECT sample_key, seq, {', '.join([snap(c) for c in doubles] + [f'CAST({c} AS BIGINT) AS {c}' for c in integers])} FROM state"

    @query(name, with_ctes(body, "state"))
    def _(spark, sf):
        return snapped(_state(spark, sf).select("sample_key", "seq", *doubles, *integers))


_state_query("a1_row_quantiles", ["p50_latency", "p90_latency", "p95_latency"])
_state_query("a2_row_moments", ["mean_latency", "max_latency", "min_latency", "std_latency"])
_state_query("a3_service_count", [], ["latency_service_count"])
_state_query("a4_start_stats", START_COLUMNS)
_state_query(
    "a5_resource_aggregates",
    [f"{f}_{s}" for f in RESOURCES for s in ("total", "max", "mean", "std")],
    [f"{f}_{s}" for f in RESOURCES for s in ("service_count", "available")],
)
_state_query("a6_safe_ratios", RATIO_COLUMNS)
_state_query("a7_pressure_net_total", ["resource_pressure", "net_total"])


@query("a8_state_from_long", with_ctes(
    f"SELECT sample_key, window_id, {_snaps([c for c in state_columns() if not c.endswith(('_count', '_available'))])} FROM state", "state"))
def _(spark, sf):
    long = inputs.telemetry_long(spark, sf)
    names = [c for c in state_columns() if not c.endswith(("_count", "_available"))]
    keys = ["sample_key", "window_id"]
    # a window has one row per service and family
    state = state_from_long(long, keys, layout=Layout(tuple(keys), not fits_task(inputs.SERVICES * 6)))
    return snapped(fill_state(state).select(*keys, *names))


# --- windows ---------------------------------------------------------------

def _dynamics_query(name: str, suffix: str) -> None:
    names = [f"{c}_{suffix}" for c in DYNAMIC_SOURCES]

    @query(name, with_ctes(f"SELECT sample_key, seq, {_snaps(names)} FROM dyn", "dyn"))
    def _(spark, sf):
        return snapped(_dynamics(spark, sf).select("sample_key", "seq", *names))


_dynamics_query("w1_difference", "diff_1")
_dynamics_query("w2_percent_change", "pct_change_1")
_dynamics_query("w3_rolling_mean", "rolling_mean_3")
_dynamics_query("w4_rolling_std", "rolling_std_3")

BASE = [*state_columns(), *[f"{c}_{s}" for c in DYNAMIC_SOURCES for s in ("diff_1", "pct_change_1", "rolling_mean_3", "rolling_std_3")]]
_COUNTS = [c for c in BASE if c.endswith(("_count", "_available"))]


def _lag_sql(lags: int) -> str:
    out = []
    for k in range(1, lags + 1):
        for c in BASE:
            lagged = f"lag({c}, {k}) OVER w"
            out.append(f"CAST({lagged} AS BIGINT) AS {c}_lag_{k}" if c in _COUNTS else snap(lagged, f"{c}_lag_{k}"))
    return f"SELECT sample_key, pos, {', '.join(out)} FROM pos WINDOW w AS (PARTITION BY sample_key ORDER BY pos)"


@query("w5_lags", with_ctes(_lag_sql(3), "pos"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    ordered = pre.ordered_by_window(prep.marked(telemetry, layout).drop("n"), layout)
    flat = pre.flatten_lags(pre.add_history(ordered, layout))
    return snapped(flat.select("sample_key", "pos", *[c for c in flat.columns if "_lag_" in c]))


_TARGET_SQL = """CAST(lead(system_anomaly) OVER w AS BIGINT) AS target_anomaly_t_plus_1,
 CAST(lead(latency_anomaly) OVER w AS BIGINT) AS target_latency_anomaly_t_plus_1,
 CAST(lead(cpu_anomaly) OVER w AS BIGINT) AS target_cpu_anomaly_t_plus_1,
 CAST(lead(memory_anomaly) OVER w AS BIGINT) AS target_memory_anomaly_t_plus_1,
 lead(p95_latency) OVER w AS raw_p95, CAST(lead(label_trace) OVER w AS BIGINT) AS target_label_trace_t_plus_1"""
_TARGETS = list(pre.TARGETS.values())
_TARGET_OUT = ", ".join(
    snap("raw_p95", t) if t == "target_p95_latency_t_plus_1" else t for t in _TARGETS
)
_WITH_TARGETS = f"(SELECT *, {_TARGET_SQL} FROM pos WINDOW w AS (PARTITION BY sample_key ORDER BY pos))"


@query("w6_future_targets", with_ctes(f"SELECT sample_key, pos, {_TARGET_OUT} FROM {_WITH_TARGETS}", "pos"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    ordered = pre.ordered_by_window(prep.marked(telemetry, layout).drop("n"), layout)
    return snapped(pre.add_history(ordered, layout).select("sample_key", "pos", *_TARGETS))


@query("w7_complete_rows", with_ctes(
    f"SELECT sample_key, pos, window_id, {_TARGET_OUT} FROM {_WITH_TARGETS} WHERE pos >= 3 AND pos < n - 1", "pos"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    ordered = pre.ordered_by_window(prep.marked(telemetry, layout).drop("n"), layout)
    kept = pre.complete_rows(pre.add_history(ordered, layout))
    return snapped(kept.select("sample_key", "pos", "window_id", *_TARGETS))


_SPLIT_SQL = """CASE WHEN pos - 3 < floor((n - 4)::DOUBLE * 0.7::DOUBLE) THEN 'train'
  WHEN pos - 3 < floor((n - 4)::DOUBLE * 0.7::DOUBLE) + floor((n - 4)::DOUBLE * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split"""
_DATASET_SQL = with_ctes(
    f"SELECT sample_key, pos, window_id, {_snaps(['p95_latency', 'p95_latency_diff_1'])}, {_TARGET_OUT}, {_SPLIT_SQL} "
    f"FROM {_WITH_TARGETS} WHERE pos >= 3 AND pos < n - 1", "pos")


@query("w8_chronological_split", _DATASET_SQL)
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    return snapped(prep.predictive(telemetry, layout).select(
        "sample_key", "pos", "window_id", "p95_latency", "p95_latency_diff_1", *_TARGETS, "split"))


@query("w9_chronological_prefix", with_ctes(
    "SELECT sample_key, seq FROM state WHERE seq < greatest(1, floor(n::DOUBLE * 0.7::DOUBLE))", "state"))
def _(spark, sf):
    telemetry, _ = inputs.telemetry(spark, sf)
    return lab.training_prefix(telemetry, ["sample_key"]).select("sample_key", "seq")


# --- labels ----------------------------------------------------------------

@query("l1_indicator_fallback", with_ctes(f"""
 SELECT sample_key, 'max_latency' AS latency_column, 'cpu_mean' AS cpu_column, 'memory_total' AS memory_column,
  {snap('quantile_cont(max_latency, 0.95)', 'latency_threshold')}, {snap('quantile_cont(cpu_mean, 0.95)', 'cpu_threshold')},
  {snap('quantile_cont(memory_total, 0.95)', 'memory_threshold')}
 FROM state WHERE seq < greatest(1, floor(n::DOUBLE * 0.7::DOUBLE)) GROUP BY 1""", "state"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf)
    foreign = fill_state(system_state(telemetry, ("sample_key", "seq", "n"))).drop("p95_latency", "cpu_total", "cpu_max")
    found = lab.thresholds(foreign, layout)
    return snapped(found.drop("anomaly_quantile", "train_frac_for_thresholds"))


@query("l2_train_thresholds", with_ctes(f"""
 SELECT sample_key, 0.95::DOUBLE AS anomaly_quantile, 0.7::DOUBLE AS train_frac_for_thresholds, 'p95_latency' AS latency_column,
  'cpu_total' AS cpu_column, 'memory_total' AS memory_column, {_snaps(['latency_threshold', 'cpu_threshold', 'memory_threshold'])}
 FROM thr""", "thr"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf)
    found = lab.thresholds(fill_state(system_state(telemetry, ("sample_key", "seq", "n"))), layout)
    exact = ["anomaly_quantile", "train_frac_for_thresholds"]
    return snapped(found.withColumns({c: F.col(c).cast("string") for c in exact})).withColumns(
        {c: F.col(c).cast("double") for c in exact})


@query("l3_anomaly_flags", with_ctes(
    f"SELECT sample_key, seq, {', '.join(f'CAST({f} AS BIGINT) AS {f}' for f in lab.FLAGS)} FROM lab", "lab"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    state = fill_state(system_state(telemetry, ("sample_key", "seq", "n")))
    return snapped(lab.label(state, layout).select("sample_key", "seq", *lab.FLAGS))


@query("l4_label_summary", with_ctes(
    "SELECT sample_key, count(*) AS row_count, " + ", ".join(
        f"CAST(sum({f}) AS BIGINT) AS {f}_count, {snap(f'avg({f})', f'{f}_share')}" for f in lab.FLAGS)
    + " FROM lab GROUP BY 1", "lab"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    state = fill_state(system_state(telemetry, ("sample_key", "seq", "n")))
    return snapped(lab.label_summary(lab.label(state, layout), ["sample_key"]))


@query("j1_threshold_join", with_ctes(
    f"SELECT sample_key, seq, {_snaps(['p95_latency', 'latency_threshold', 'cpu_threshold', 'memory_threshold'])} FROM state JOIN thr USING (sample_key)",
    "state", "thr"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    state = fill_state(system_state(telemetry, ("sample_key", "seq", "n")))
    limits = lab.thresholds(state, layout)
    return snapped(state.join(limits, "sample_key").select(
        "sample_key", "seq", "p95_latency", "latency_threshold", "cpu_threshold", "memory_threshold"))


# --- validation of samples -------------------------------------------------

_RUN_SQL = """
 SELECT sample_key, n AS aggregated_rows, greatest(n - 4, 0) AS predictive_rows,
  CASE WHEN n < 35 OR greatest(n - 4, 0) < 35 THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN n < 35 THEN 'too few rows after aggregation' WHEN greatest(n - 4, 0) < 35 THEN 'too few rows after predictive processing' END AS reason
 FROM (SELECT event_type || '/run_' || (user_id % 50) AS sample_key, count(DISTINCT us // 21600000000) AS n FROM ev GROUP BY 1)"""


def _status(spark: SparkSession, sf: str) -> DataFrame:
    telemetry, layout = inputs.telemetry(spark, sf, sample=inputs.by_run(), stored=True)
    return prep.status(telemetry, prep.predictive(telemetry, layout), prep.Settings(min_rows=35))


@query("v6_minimum_rows", with_ctes(_RUN_SQL, "ev"))
def _(spark, sf):
    return _status(spark, sf)


@query("v7_failure_isolation", with_ctes(
    f"SELECT count(*) FILTER (status = 'ok') AS processed_count, count(*) FILTER (status = 'failed') AS failed_count FROM ({_RUN_SQL})", "ev"))
def _(spark, sf):
    return run_totals(_status(spark, sf))


def _matched(family: str, suffix: str) -> str:
    names = ", ".join(f"{s}_{suffix}" for s in range(inputs.SERVICES))
    value = f"'{names}'" if family != "net_tx" else f"CASE WHEN sample_key = 'signup' THEN '' ELSE '{names}' END"
    return f"{value} AS {family}_columns"


@query("v8_sample_audit", with_ctes(
    "SELECT sample_key, count(*) AS row_count_source, count(*) AS row_count_aggregated, 261::BIGINT AS lag_columns_count, "
    + ", ".join([_matched("latency", "latency"), _matched("start", "start"),
                 _matched("cpu", "container_cpu_usage_seconds_total"), _matched("memory", "container_memory_usage_bytes"),
                 _matched("net_rx", "container_network_receive_bytes_total"),
                 _matched("net_tx", "container_network_transmit_bytes_total")])
    + ", " + ", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}_count, {snap(f'avg({f})', f'{f}_share')}" for f in lab.FLAGS)
    + " FROM lab GROUP BY 1", "lab"))
def _(spark, sf):
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    labelled = prep.marked(telemetry, layout)
    return snapped(prep.audit(telemetry, labelled, 3 * len(pre.lag_base(labelled))))

