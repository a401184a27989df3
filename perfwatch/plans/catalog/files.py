"""Queries of file scans, sinks, the manifest and schema checks.

Scans and sinks work on trees that are first written from the given tables
into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.operators import families as fam
from perfwatch.operators import manifest as mf
from perfwatch.operators import reports as rep
from perfwatch.operators import validation as val
from perfwatch.operators.ordering import measure, positions
from perfwatch.operators.state import system_state
from perfwatch.plans import inputs, training
from perfwatch.plans import preprocessing as prep
from perfwatch.plans.catalog.registry import query, snap, snapped
from perfwatch.plans.catalog.sql import with_ctes
from perfwatch.plans.catalog.telemetry import _DATASET_SQL, _TARGETS, _wide_sql
from perfwatch.session import stage, staging_path
from perfwatch.sources import files as src
from perfwatch.sources import writers as out
from perfwatch.sources.listing import every_file

TX = fam.RESOURCE_FAMILIES["net_tx"]


def csv_tree(spark: SparkSession, sf: str) -> str:
    """Wide telemetry as a CSV tree: one directory per sample, ``signup`` with a shorter header, notes of two lines."""
    root = staging_path(spark, "csv")
    wide = inputs.telemetry_wide(spark, sf)
    wide = wide.drop(*[f"{f}_available" for f in fam.family_columns(wide)])
    wide = wide.withColumn("note", F.format_string('line one\nwindow %d said "x", twice', "window_id"))
    # one staged table feeds both writes
    ordered = wide.repartition("sample_key").sortWithinPartitions("sample_key", "window_id")
    for rows, name in (
        (ordered.where("sample_key <> 'signup'"), "full"),
        (ordered.where("sample_key = 'signup'").drop(*fam.token_columns(wide, TX)), "short"),
    ):
        rows.write.partitionBy("sample_key").option("header", "true").option("escape", '"').csv(f"{root}/{name}")
    return root


def state_tree(spark: SparkSession, sf: str) -> str:
    """System state as another tool leaves it: a directory per sample, without places, in file order."""
    root = staging_path(spark, "state")
    telemetry, _ = inputs.telemetry(spark, sf)
    state = system_state(telemetry, prep.ORDER).drop("n").withColumns({"sample": F.col("sample_key"), "file_role": F.lit("aggregated")})
    ordered = state.repartition("sample").sortWithinPartitions("sample", "seq")
    ordered.write.partitionBy("sample", "file_role").parquet(f"{root}/{mf.ROOT_NAME}/part_0")
    return root


def _relative(path, root: str):
    return F.regexp_replace(src.plain_path(path), f"^{root}/", "")


def _sample_of(path):
    return F.regexp_extract(path, "sample_key=([^/]+)", 1)


@query("s1_discover_files", "SELECT event_type AS sample, 1::BIGINT AS file_count FROM events GROUP BY 1")
def _(spark, sf):
    found = src.discover(spark, csv_tree(spark, sf))
    return found.groupBy(_sample_of(F.col("path")).alias("sample")).agg(F.count(F.lit(1)).alias("file_count"))


@query("s1_every_file", "SELECT event_type AS sample, NULL AS left_out, 1::BIGINT AS file_count FROM events GROUP BY 1 UNION ALL SELECT '', 'empty file', 2")
def _(spark, sf):
    """The files of the tree, and the two empty markers that its writes left."""
    found = every_file(spark, csv_tree(spark, sf), "").where(F.col("path").rlike(r"(\.csv|/_SUCCESS)$"))
    return found.groupBy(_sample_of(F.col("path")).alias("sample"), "left_out").agg(F.count(F.lit(1)).alias("file_count"))


@query("s2_batch_slice", with_ctes("""
 SELECT path, i AS file_index, printf('part_%04d_%04d', 50, least(100, total) - 1) AS part_name
 FROM (SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS i, count(*) OVER () AS total FROM paths)
 WHERE i BETWEEN 50 AND 99""", "paths"))
def _(spark, sf):
    return src.batch_slice(inputs.file_paths(spark, sf), 50, 50)


@query("s3_csv_scan", with_ctes(
    "SELECT w.*, seq, printf('line one%swindow %d said \"x\", twice', chr(10), w.window_id) AS note, CASE WHEN w.sample_key = 'signup' THEN 0::BIGINT ELSE 1::BIGINT END AS net_tx_available "
    f"FROM ({_wide_sql()}) w JOIN raw_state USING (sample_key, window_id)", "raw_state"))
def _(spark, sf):
    wide, _ = src.read_telemetry_csv(spark, csv_tree(spark, sf))
    named = wide.withColumn("sample_key", _sample_of(F.col("sample_key")))
    values = [c for cols in fam.family_columns(wide).values() for c in cols]
    return snapped(named.select("sample_key", "window_id", "seq", "note", "net_tx_available", *values))


@query("s5_json_scan", with_ctes(f"""
 SELECT scenario, model, split, {snap('mae', '"scores.mae"')}, {snap('rmse', '"scores.rmse"')} FROM met""", "met"))
def _(spark, sf):
    path = staging_path(spark, "json")
    inputs.metrics(spark, sf).select("scenario", "model", "split", F.struct("mae", "rmse").alias("scores")
    ).write.option("maxRecordsPerFile", 1).json(path)  # one document per file
    flat = src.read_json(
        spark, path, schema="scenario string, model string, split string, scores struct<mae: double, rmse: double>")
    return snapped(flat.toDF("scenario", "model", "split", "mae", "rmse")).toDF(
        "scenario", "model", "split", "scores.mae", "scores.rmse")


@query("s6_tolerant_read", "SELECT event_type, count(*) AS rows, 1::BIGINT AS skipped_files FROM events GROUP BY 1")
def _(spark, sf):
    root = staging_path(spark, "tolerant")
    events = inputs.table(spark, sf, "events").select("event_type", "event_id", "value")
    events.write.parquet(f"{root}/good")
    # text files under Parquet names
    events.select("event_type").distinct().coalesce(1).write.option("extension", "parquet").csv(f"{root}/bad")
    listing = src.discover(spark, root, ".parquet")
    rows, skipped = src.read_tolerant(spark, listing, root, events.schema)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "skipped_files", skipped.agg(F.count(F.lit(1))).scalar())


@query("s7_role_rows", with_ctes(
    "SELECT sample_key, count(*) AS rows, min(seq) AS first, max(seq) AS last FROM state WHERE sample_key <> 'view' GROUP BY 1", "state"))
def _(spark, sf):
    root = state_tree(spark, sf)
    index = mf.files_index(src.discover(spark, root, "").select("path"))
    rows = src.read_role(spark, index.where("relative_path_from_part not like '%sample=view/%'"), "aggregated")
    return rows.groupBy("sample_key").agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first"), F.max("seq").alias("last"))


@query("s9_row_cap_of_files", with_ctes("SELECT sample_key, seq, window_id FROM state WHERE seq BETWEEN 0 AND 49", "state"))
def _(spark, sf):
    index = mf.files_index(src.discover(spark, state_tree(spark, sf), "").select("path"))
    return training.load_role(spark, index, "aggregated", max_rows=50).select("sample_key", "seq", "window_id")


@query("s10_sample_of_files", with_ctes(
    "SELECT sample_key, round_even(0.1 * least(50, count(*)), 0)::BIGINT AS rows, "
    "count(*)::BIGINT AS of_rows FROM state GROUP BY 1", "state"))
def _(spark, sf):
    index = mf.files_index(src.discover(spark, state_tree(spark, sf), "").select("path"))
    drawn = training.load_role(spark, index, "aggregated", sample_frac=0.1, max_rows=50)
    whole = training.load_role(spark, index, "aggregated").groupBy("sample_key").agg(F.count(F.lit(1)).alias("of_rows"))
    return drawn.groupBy("sample_key").agg(F.count(F.lit(1)).alias("rows")).join(whole, "sample_key")


@query("s7_manifest_role_scan", with_ctes(
    "SELECT absolute_path, logical_sample_key FROM idx WHERE file_role = 'train' AND scenario = 'click'", "idx"))
def _(spark, sf):
    index = mf.files_index(inputs.file_paths(spark, sf))
    return src.select_role(index, "train", "click").select("absolute_path", "logical_sample_key")


@query("s12_dimensions", with_ctes("""
 SELECT scenario, source_operation, source_service, target_service, node FROM edges LEFT JOIN place ON service = target_service""",
    "edges", "place"))
def _(spark, sf):
    root = staging_path(spark, "dimensions")
    inputs.service_edges(spark, sf).select(
        "scenario", "source_operation", "source_service", "target_service").write.option("header", "true").csv(f"{root}/rpc")
    inputs.placement(spark, sf).write.option("header", "true").csv(f"{root}/placement")
    edges = src.read_dimension(spark, f"{root}/rpc", src.RPC_SCHEMA)
    nodes = src.read_dimension(spark, f"{root}/placement", src.PLACEMENT_SCHEMA)
    return edges.join(nodes, edges.target_service == nodes.service, "left").drop("service")


# --- sinks -----------------------------------------------------------------

@query("k1_table_sink", f"SELECT o_orderkey, {snap('o_totalprice')}, o_orderstatus FROM orders")
def _(spark, sf):
    root = staging_path(spark, "tables")
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    out.save_table(orders, f"{root}/orders.csv")
    read = src.read_table(spark, f"{root}/orders.csv", orders.schema)
    out.save_table(read, f"{root}/orders.parquet")
    return snapped(src.read_table(spark, f"{root}/orders.parquet"))


@query("k2_output_layout", with_ctes("""
 SELECT substr(path, 36) AS relpath, 'predictive_processed_dataset/part_0000_0049/' || regexp_replace(substr(path, 36), '\\.[^.]*$', '') AS output_dir
 FROM paths""", "paths"))
def _(spark, sf):
    relative = F.expr(f"substring(path, {len(inputs.ROOT) + 2})")
    return inputs.file_paths(spark, sf).select(
        relative.alias("relpath"), out.output_dir(relative, F.lit("part_0000_0049")).alias("output_dir"))


def prediction_tree(spark: SparkSession, rows: DataFrame, keys: list[str], as_csv: str) -> str:
    """Prediction tables ``<keys>/<model>_test_predictions.*`` in stored order ``step``, some as CSV, and a damaged one."""
    root = staging_path(spark, "predictions")
    table = [*keys, "model"]
    stored = stage(rows.withColumn("_csv", F.expr(as_csv)), "trees")
    for kind, of_kind in (("parquet", "NOT _csv"), ("csv", "_csv")):
        named = stored.where(of_kind).withColumn("model", F.concat("model", F.lit(f"_test_predictions.{kind}")))
        # sorted under the final names: the writer replaces a sort by other columns with its own, which drops ``step``
        ordered = named.repartition(*table).sortWithinPartitions(*table, "step").drop("step", "_csv")
        ordered.write.mode("append").partitionBy(*table).option("header", "true").format(kind).save(f"{root}/{kind}")
    damaged = rows.limit(1).select(F.lit("no table").alias("x"), F.lit("broken_test_predictions.parquet").alias("model"))
    damaged.write.mode("append").partitionBy("model").option("extension", "parquet").csv(f"{root}/more/{keys[-1]}=bad")
    return root


def written_dataset(spark: SparkSession, sf: str) -> str:
    """The predictive dataset written by split under a new root."""
    root = staging_path(spark, "dataset")
    telemetry, layout = inputs.telemetry(spark, sf, stored=True)
    out.save_stage(prep.predictive(telemetry, layout), root, F.col("split"))
    return root


@query("k3_stage_outputs", _DATASET_SQL)
def _(spark, sf):
    stored = src.read_parquet(spark, f"{written_dataset(spark, sf)}/{out.DATASET_DIR}")
    return snapped(stored.select(
        "sample_key", "pos", "window_id", "p95_latency", "p95_latency_diff_1", *_TARGETS, F.col("file_role").alias("split")))


@query("k4_json_metadata", with_ctes("""
 SELECT sample_key, count(*) AS rows, bool_and(window_id >= 0) AS valid FROM state GROUP BY 1""", "state"))
def _(spark, sf):
    path = staging_path(spark, "metadata") + ".json"
    telemetry, _ = inputs.telemetry(spark, sf)
    status = telemetry.groupBy("sample_key").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("window_id") >= 0).alias("valid"))
    out.save_json(status, path)
    return spark.read.schema("sample_key string, rows bigint, valid boolean").json(path)


@query("k5_preview", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 20")
def _(spark, sf):
    return out.preview(inputs.table(spark, sf, "events").select("event_id", "event_type"), ["event_id"])


@query("k6_report_export", with_ctes(f"""
 SELECT scenario, model, {snap('mae')}, {snap('rmse')} FROM met WHERE split = 'test'""", "met"))
def _(spark, sf):
    path = staging_path(spark, "export")
    report = rep.test_comparison(inputs.metrics(spark, sf)).select("scenario", "model", "mae", "rmse")
    out.export_report(report, path)
    return snapped(spark.read.option("header", "true").schema(report.schema).csv(path))


# --- manifest --------------------------------------------------------------

@query("m1_dataset_roots", with_ctes("SELECT DISTINCT substr(path, 1, 34) AS predictive_root FROM paths", "paths"))
def _(spark, sf):
    return mf.dataset_roots(inputs.file_paths(spark, sf))


_INDEX_COLUMNS = "absolute_path, file_role, relative_path_from_part, predictive_root, part_name, scenario, logical_sample_key, file_name, file_suffix, parent_dir_name"


@query("m2_files_index", with_ctes(f"SELECT {_INDEX_COLUMNS} FROM idx", "idx"))
def _(spark, sf):
    return mf.files_index(inputs.file_paths(spark, sf))


@query("m3_samples_index", with_ctes("SELECT '/data/predictive_processed_dataset' AS predictive_root, * FROM smp", "smp"))
def _(spark, sf):
    return mf.samples_index(mf.files_index(inputs.file_paths(spark, sf)))


@query("m4_role_index", with_ctes("SELECT * FROM rol", "rol"))
def _(spark, sf):
    return mf.role_index(mf.files_index(inputs.file_paths(spark, sf)))


@query("m5_manifest_summary", with_ctes("""
 SELECT (SELECT count(*) FROM smp) AS sample_count, (SELECT count(*) FROM smp WHERE is_complete_for_training) AS complete_training_sample_count,
  (SELECT count(*) FROM idx) AS file_count, (SELECT string_agg(DISTINCT scenario, ',' ORDER BY scenario) FROM idx) AS scenarios,
  (SELECT string_agg(file_role || ':' || file_suffix || ':' || file_count, ',' ORDER BY file_role, file_suffix) FROM rol) AS roles""",
    "smp", "rol"))
def _(spark, sf):
    summary = mf.manifest_summary(mf.files_index(inputs.file_paths(spark, sf)))
    role = F.transform("roles", lambda r: F.concat_ws(":", r.file_role, r.file_suffix, r.file_count.cast("string")))
    return summary.withColumns({"scenarios": F.array_join("scenarios", ","), "roles": F.array_join(role, ",")})


@query("u2_distinct_scenarios", with_ctes("SELECT DISTINCT scenario FROM idx WHERE scenario IS NOT NULL", "idx"))
def _(spark, sf):
    index = mf.files_index(inputs.file_paths(spark, sf))
    return index.select("scenario").where("scenario is not null").distinct().orderBy("scenario")


@query("u3_distinct_roots", with_ctes(
    "SELECT DISTINCT regexp_extract(path, '^(.*/part_[0-9]+)/', 1) AS root FROM paths", "paths"))
def _(spark, sf):
    paths = inputs.file_paths(spark, sf)
    return paths.select(F.regexp_extract("path", "^(.*/part_[0-9]+)/", 1).alias("root")).distinct().orderBy("root")


@query("o1_multi_key_sort", with_ctes("""
 SELECT row_number() OVER (ORDER BY part_name, scenario, logical_sample_key, file_role, absolute_path) AS place, absolute_path FROM idx""", "idx"))
def _(spark, sf):
    index = mf.sorted_index(mf.files_index(inputs.file_paths(spark, sf))).select("absolute_path", *mf.ORDER)
    placed = positions(index, measure(index, []), [*mf.ORDER, "absolute_path"], "place")
    return placed.select((F.col("place") + 1).alias("place"), "absolute_path")


# --- checks ----------------------------------------------------------------

@query("v1_required_columns", "SELECT event_id, value FROM events")
def _(spark, sf):
    return val.require_columns(inputs.table(spark, sf, "events"), ["event_id", "value"]).select("event_id", "value")


@query("v2_target_column", with_ctes("SELECT event_type, event_id, next_value AS target_value_t_plus_1 FROM preds", "preds"))
def _(spark, sf):
    rows, _ = inputs.next_values(spark, sf)
    named = rows.withColumnRenamed("next_value", "target_value_t_plus_1")
    return val.require_target(named, "target_value_t_plus_1").select("event_type", "event_id", "target_value_t_plus_1")


@query("v3_non_empty", "SELECT c_custkey FROM customer")
def _(spark, sf):
    return val.require_rows(inputs.table(spark, sf, "customer")).select("c_custkey")


@query("v4_probability_range", """
 SELECT count(*) FILTER (value / 200 < 0 OR value / 200 > 1) AS outside_unit_range, count(value) AS checked_values FROM events""")
def _(spark, sf):
    return val.probability_violations(inputs.table(spark, sf, "events").select((F.col("value") / 200).alias("p")), "p")


@query("v5_allowed_values", with_ctes("""
 SELECT scenario, count(*) AS row_count FROM idx WHERE scenario NOT IN ('click', 'view', 'purchase') GROUP BY 1""", "idx"))
def _(spark, sf):
    index = mf.files_index(inputs.file_paths(spark, sf))
    return val.unexpected_values(val.require_allowed(index, "file_role", val.FILE_ROLES), "scenario", ["click", "view", "purchase"])


@query("r25_experiment_overview", with_ctes("""
 SELECT count(*) AS sample_count, count(*) FILTER (is_complete_for_training) AS complete_count,
  string_agg(DISTINCT scenario, ', ' ORDER BY scenario) AS scenarios, CAST((SELECT sum(file_count) FROM rol) AS BIGINT) AS file_count
 FROM smp""", "smp", "rol"))
def _(spark, sf):
    index = mf.files_index(inputs.file_paths(spark, sf))
    return rep.experiment_overview(mf.samples_index(index), mf.role_index(index))


@query("r26_integrity_table", with_ctes(
    "SELECT logical_sample_key, has_train, has_val, has_test, is_complete_for_training FROM smp", "smp"))
def _(spark, sf):
    return rep.integrity_table(mf.samples_index(mf.files_index(inputs.file_paths(spark, sf))))
