"""Training from a manifest, and building the manifest: what a user runs end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.operators import manifest as mf
from perfwatch.operators import ml
from perfwatch.operators.columns import align
from perfwatch.operators.evaluate import metrics_document
from perfwatch.operators.labels import label, label_summary, thresholds
from perfwatch.operators.ordering import Layout, fits_task, join_on, measure, positions
from perfwatch.operators.predictive import flatten_lags, predictive_dataset
from perfwatch.operators.validation import require_rows, require_success
from perfwatch.plans.preprocessing import Settings, aggregated, sample_metadata, status
from perfwatch.session import stage
from perfwatch.sources import files as src
from perfwatch.sources import writers as out
from perfwatch.sources.listing import EMPTY, HIDDEN, every_file
from perfwatch.sources.tables import capped, sampled

TARGETS = {"regression": "target_p95_latency_t_plus_1", "classification": "target_anomaly_t_plus_1"}
REGRESSION = ["mae", "rmse", "r2"]
UNREADABLE = "unreadable file"
CLASSIFICATION = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def run_preprocessing(
    spark: SparkSession, input_root: str, output_root: str, settings: Settings = Settings(),
    start: int = 0, size: int | None = None, every: bool = True,
) -> DataFrame:
    """CSV tree to stage outputs; returns the status of each sample.

    Every file is accounted for: those that Spark's scans skip (no bytes, a
    hidden name) are failed samples with that reason. ``every=False`` leaves
    them out, for a store that only Spark reaches.

    Samples that fail a gate are reported and left out of the later stages;
    the run fails only if no sample passes. Outputs are written under a version
    of their own and become valid together, with the commit at the end.
    """
    if every:
        listing = every_file(spark, input_root)
    else:
        listing = src.discover(spark, input_root).withColumn("left_out", F.lit(None).cast("string"))
    listing = stage(listing, "listing")  # files that arrive meanwhile belong to the next run
    chosen = src.batch_slice(listing, start, size).join(listing, "path")
    part = chosen.agg(F.max("part_name")).first()[0]
    version = out.new_version()
    stored_part = out.versioned(part, version)
    lines = src.csv_lines(spark, input_root, chosen)
    telemetry, layout = src.read_telemetry_csv(spark, input_root, chosen, lines)
    telemetry = stage(telemetry, "telemetry")  # typed columns: text is parsed once
    enough = telemetry.where(F.col("n") >= settings.min_rows)
    samples = stage(enough.select("sample_key").distinct(), "samples")

    def stored_stage(rows: DataFrame, role: str) -> DataFrame:
        """Each stage reads the stored columns of the one before, of the samples of this run only."""
        out.save_stage(rows, output_root, role, stored_part)
        return out.load_stage(spark, rows.schema, output_root, role, stored_part).join(samples, "sample_key", "left_semi")

    state = stored_stage(aggregated(enough, layout, settings), "aggregated")
    labelled = stored_stage(label(state, layout, settings.anomaly_quantile, settings.train), "marked")
    dataset = stage(flatten_lags(predictive_dataset(
        labelled, layout, settings.n_lags, settings.horizon, settings.train, settings.val, settings.test
    )), "predictive")
    report = status(telemetry, dataset, settings)
    read = src.csv_headers(lines).select(F.col("path").alias("_path"))
    unread = chosen.join(read, src.plain_path(F.col("path")) == F.col("_path"), "left_anti").select(
        F.col("path").alias("sample_key"), F.lit(0).cast("bigint").alias("aggregated_rows"),
        F.lit(0).cast("bigint").alias("predictive_rows"), F.lit("failed").alias("status"),
        F.coalesce("left_out", F.lit(UNREADABLE)).alias("reason"),
    )
    path = f"{output_root}/metadata/preprocessing_{part}.json"
    summary = label_summary(labelled, ["sample_key"]).drop("row_count")
    out.save_json(report.unionByName(unread).join(summary, "sample_key", "left"), path)
    stored = spark.read.schema(report.schema).json(path)
    require_success(stored)
    good = stored.where("status = 'ok'").select("sample_key")
    passed = dataset.join(good, "sample_key", "left_semi")
    out.save_stage(passed, output_root, "predictive", stored_part)
    out.save_stage(passed, output_root, F.col("split"), stored_part)
    limits = thresholds(state, layout, settings.anomaly_quantile, settings.train)
    document = sample_metadata(telemetry, labelled, limits, passed)
    out.save_stage(document.join(good, "sample_key", "left_semi"), output_root, "metadata", stored_part, "json")
    unread = F.col("reason").isin(UNREADABLE, EMPTY, HIDDEN)
    of_path = F.regexp_replace(src.below_root(F.col("sample_key"), input_root), r"\.[^./]*$", "")
    out.commit(stored.withColumn("sample_key", F.when(unread, of_path).otherwise(F.col("sample_key"))), output_root, version)
    return stored


def run_manifest(spark: SparkSession, search_root: str, output_dir: str) -> DataFrame:
    """Index the processed files under a root; writes three tables and a summary."""
    files = src.discover(spark, search_root, "")
    index = require_rows(mf.files_index(files.select("path")), "Manifest")
    tables = {
        "merged_files_index": mf.sorted_index(index),
        "merged_samples_index": mf.samples_index(index),
        "merged_role_index": mf.role_index(index),
    }
    for name, table in tables.items():
        out.save_table(table, f"{output_dir}/{name}.parquet")
        out.save_table(table, f"{output_dir}/{name}.csv")
    summary = mf.manifest_summary(index).withColumn("created_at_utc", F.current_timestamp())
    out.save_json(summary, f"{output_dir}/merged_manifest.json")
    return index


def load_role(
    spark: SparkSession, manifest: DataFrame, role: str, scenario: str | None = None,
    sample_frac: float | None = None, max_rows: int | None = None, seed: int = 42,
) -> DataFrame:
    """Rows of a role with the per-source cap and the seeded per-source sample.

    Rows of this library's own stages are placed by ``pos`` in their sample.
    Those of any other tool are placed by stored order in their source: a
    file, or a directory of part files.
    """
    rows = src.read_role(spark, manifest, role, scenario, ordered=True)
    order = ["_file", "_block", "_row"]
    if not {"sample_key", "pos"} <= set(rows.columns):
        layout = measure(rows, ["_source"])
        rows = positions(rows, layout, order, "_place", "_rows")
        rows = capped(rows, max_rows, "_place").withColumn("_rows", F.least("_rows", F.lit(max_rows)) if max_rows is not None else F.col("_rows"))
        return sampled(rows, layout, sample_frac, seed, "_place", "_rows").drop("_source", "_place", "_rows", *order)
    rows = rows.drop("_source", *order)
    # a split is one run of consecutive places, so its first place and size tell the rest
    runs = rows.groupBy("sample_key").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    rows = join_on(rows, runs, ["sample_key"]).withColumn("_place", F.col("pos") - F.col("_first"))
    if max_rows is not None:
        rows = capped(rows, max_rows, "_place").withColumn("_rows", F.least(F.col("_rows"), F.lit(max_rows)))
    longest = runs.agg(F.max("_rows")).first()[0] or 0
    drawn = sampled(rows, Layout(("sample_key",), not fits_task(longest)), sample_frac, seed, "_place", "_rows")
    return drawn.drop("_place", "_rows", "_first")


def run_training(
    spark: SparkSession, manifest: DataFrame, output_root: str, task: str, scenario: str = "all",
    sample_frac: float | None = 0.10, max_rows: int | None = None, seed: int = 42,
    models: tuple[str, ...] = ml.MODELS, target: str | None = None, **sizes: int,
) -> DataFrame:
    """Train on the manifest's splits; writes models, predictions and metrics."""
    target = target or TARGETS[task]
    parts = [load_role(spark, manifest, r, scenario, sample_frac, max_rows, seed) for r in ("train", "val", "test")]
    train_columns = parts[0].columns
    dataset = parts[0]
    for part in parts[1:]:
        dataset = dataset.unionByName(align(part, train_columns))  # a column that only train has is 0
    trained = ml.train_and_evaluate(dataset, target, task, models, seed, **sizes)
    ml.save_models(trained.models, output_root, task, scenario)
    for name in models:
        out.save_table(
            trained.predictions.where(F.col("model") == name).drop("model"),
            f"{output_root}/predictions/{task}/{scenario}/{name}_test_predictions.parquet",
        )
    reports = f"{output_root}/reports/{task}/{scenario}"
    names = REGRESSION if task == "regression" else CLASSIFICATION
    metrics = trained.metrics.select("model", "split", *names)
    out.save_table(metrics, f"{reports}/{task}_metrics.csv")
    stored = spark.read.schema(metrics.schema).option("header", "true").csv(f"{reports}/{task}_metrics.csv")
    trained.release()
    document = metrics_document(stored.withColumn("scenario", F.lit(scenario)), ["scenario"], names)
    sizes = {r["split"]: r["count"] for r in dataset.groupBy("split").count().collect()}
    facts = {"target_col": F.lit(target), "feature_count": F.lit(len(trained.features))}
    facts |= {f"{part}_rows": F.lit(sizes.get(part, 0)).cast("bigint") for part in ("train", "val", "test")}
    if task == "classification":
        share = dataset.where("split = 'train'").agg(F.avg(F.col(target).cast("double"))).first()[0]
        facts["positive_share_train"] = F.lit(share).cast("double")
    out.save_json(document.withColumns(facts), f"{reports}/{task}_metrics.json")
    return stored
