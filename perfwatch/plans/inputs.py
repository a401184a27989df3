"""Telemetry, predictions, file paths, service graph and metrics derived from the given tables.

Each function declares a DataFrame over whole tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfwatch.functions.scalars import part_of
from perfwatch.operators.evaluate import classification_metrics, regression_metrics, roc_auc
from perfwatch.operators.families import RESOURCE_FAMILIES
from perfwatch.operators.ordering import Layout, fits_task, in_order, measure, measure_nested, positions
from perfwatch.operators.quantile import exact_quantiles
from perfwatch.session import reused

WINDOW_MICROS = 21_600_000_000  # six hours
SERVICES = 4
SLOW = 100.0
QUANTILE = 0.95

# File stems of the path fixture, by event_id % 8.
STEMS = [
    "train", "val", "test", "metadata", "predictive_p95_dataset",
    "aggregated_system_state", "marked_anomaly_state", "aggregation_metadata",
]
ROOT = "/data/predictive_processed_dataset"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with microseconds since the epoch (``us``) and the counter ``k`` of ``props``."""
    wall = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return table(spark, sf_dir, "events").withColumns({
        "us": F.unix_micros(wall),
        "k": F.get_json_object("props", "$.k").cast("double"),
    })


def window_of(window: int) -> Column:
    return F.expr(f"us div {window}")


def by_type() -> Column:
    return F.col("event_type")


def by_run() -> Column:
    """Finer samples, some of them too short to use."""
    return F.concat(F.col("event_type"), F.lit("/run_"), (F.col("user_id") % 50).cast("string"))


def telemetry_wide(
    spark: SparkSession, sf_dir: str, window: int = WINDOW_MICROS, sample: Column | None = None
) -> DataFrame:
    """One row per sample and window, service columns side by side, without ``seq``.

    Conditional aggregates build all service columns in one pass with map-side
    combine. ``signup`` has no transmit columns in its header.
    """
    data = events(spark, sf_dir)
    aggs = []
    for s in range(SERVICES):
        mine = f"FILTER (WHERE user_id % {SERVICES} = {s})"
        aggs += [
            f"avg(value) {mine} AS `{s}_latency`",
            f"min(us % {window}) {mine} / 1e6D AS `{s}_start`",
            f"sum(k) {mine} AS `{s}_container_cpu_usage_seconds_total`",
            f"sum(value) {mine} AS `{s}_container_memory_usage_bytes`",
            f"max(k) {mine} AS `{s}_container_network_receive_bytes_total`",
            f"double(nullif(count_if(event_type <> 'signup') {mine}, 0)) AS `{s}_container_network_transmit_bytes_total`",
        ]
    aggs.append(f"int(max(value) >= {SLOW}D) AS label_trace")
    aggs = [F.expr(a) for a in aggs]
    wide = data.groupBy(
        (by_type() if sample is None else sample).alias("sample_key"), window_of(window).alias("window_id")
    ).agg(*aggs)
    flags = {f"{f}_available": F.lit(1) for f in ("latency", "start", *RESOURCE_FAMILIES)}
    flags["net_tx_available"] = F.when(F.col("sample_key").startswith("signup"), 0).otherwise(1)
    return wide.withColumns(flags)


def telemetry(
    spark: SparkSession, sf_dir: str, window: int = WINDOW_MICROS, sample: Column | None = None,
    stored: bool = False,
) -> tuple[DataFrame, Layout]:
    """Wide telemetry with the row order ``seq`` and the layout of its samples.

    ``stored`` is for plans that read the rows more than once (thresholds and
    labels, for one): of large events the wide rows are written first, so the
    events are scanned a single time.
    """
    made = telemetry_wide(spark, sf_dir, window, sample)
    wide = reused(made, "telemetry") if stored else made
    if wide is not made:
        layout = measure(wide, ["sample_key"])
    else:
        # the longest sample has at most as many rows as the time span has windows
        first, last = events(spark, sf_dir).agg(F.min("us"), F.max("us")).first()
        windows = (last // window - first // window + 1) if first is not None else 0
        layout = Layout(("sample_key",), not fits_task(windows))
    return positions(wide, layout, ["window_id"], "seq", "n"), layout


def telemetry_long(spark: SparkSession, sf_dir: str, window: int = WINDOW_MICROS) -> DataFrame:
    """(sample_key, window_id, service_id, family, value) rows without NULLs."""
    grouped = events(spark, sf_dir).groupBy(
        F.col("event_type").alias("sample_key"),
        window_of(window).alias("window_id"),
        (F.col("user_id") % SERVICES).cast("int").alias("service_id"),
    ).agg(
        F.avg("value").alias("latency"),
        (F.min(F.col("us") % window) / F.lit(1e6)).alias("start"),
        F.sum("k").alias("cpu"), F.sum("value").alias("memory"), F.max("k").alias("net_rx"),
        F.when(F.col("sample_key") != "signup", F.count(F.lit(1)).cast("double")).alias("net_tx"),
    )
    families = ["latency", "start", *RESOURCE_FAMILIES]
    ids = ["sample_key", "window_id", "service_id"]
    return grouped.unpivot(ids, families, "family", "value").where("value is not null")


def next_values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Each event with its place among the events of its type and the next value."""
    data = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    layout = measure(data, ["event_type"])
    placed = positions(data, layout, ["event_id"], "pos", "n")
    return in_order(
        placed, layout, "pos", 0, 1, lambda w: {"next_value": F.lead("value", 1).over(w)}
    ).where(F.col("pos") < F.col("n") - 1), layout


def class_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Persistence forecasts of ``value >= 50`` with a probability; one file per event type."""
    rows, layout = next_values(spark, sf_dir)
    out = rows.select(
        F.col("event_type").alias("prediction_file"),
        F.col("pos").alias("step"),
        F.lit("test").alias("split"),
        (F.col("next_value") >= 50).cast("int").alias("y_true"),
        (F.col("value") >= 50).cast("int").alias("y_pred"),
        F.least(F.lit(1.0), F.col("value") / 200).alias("anomaly_probability"),
    )
    return out, layout.by("prediction_file")


def value_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression forecasts by scenario (event type), model and third of the sequence."""
    rows, layout = next_values(spark, sf_dir)
    medians = exact_quantiles(
        table(spark, sf_dir, "events").select("event_type", "value"), layout, {"median": ("value", 0.5)}
    )
    third = F.least(F.lit(2), F.floor(F.col("pos") * 3 / (F.col("n") - 1)))
    models = F.inline(F.array(
        F.struct(F.lit("persistence").alias("model"), F.col("value").alias("y_pred")),
        F.struct(F.lit("median").alias("model"), F.col("median").alias("y_pred")),
    ))
    return rows.join(medians, "event_type").select(
        F.col("event_type").alias("scenario"),
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (third + 1).cast("int")).alias("split"),
        F.col("pos").alias("step"),
        F.col("next_value").alias("y_true"),
        models,
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression metrics per scenario, model and split."""
    return regression_metrics(value_predictions(spark, sf_dir), ["scenario", "model", "split"])


def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, layout = class_predictions(spark, sf_dir)
    keys = ["prediction_file"]
    return classification_metrics(predictions, keys).join(roc_auc(predictions, keys, layout=layout), keys)


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct paths of processed files.

    Events fold to one representative per path before any text is built, so
    the path expressions, and filters on them, run once per path.
    """
    seen = table(spark, sf_dir, "events").groupBy(
        "event_type", (F.col("user_id") % 150).alias("_run"), (F.col("event_id") % 8).alias("_kind")
    ).agg(F.min("user_id").alias("user_id"), F.min("event_id").alias("event_id"))
    kind = (F.col("event_id") % 8).cast("int")
    stem = F.element_at(F.array(*[F.lit(s) for s in STEMS]), kind + 1)
    suffix = F.when(kind.isin(3, 7), F.lit(".json")).otherwise(F.lit(".parquet"))
    return seen.select(F.concat(
        F.lit(f"{ROOT}/part_000"), (F.col("user_id") % 3).cast("string"), F.lit("/"), F.col("event_type"),
        F.lit("/run_"), (F.col("user_id") % 50).cast("string"), F.lit("/"), stem, suffix,
    ).alias("path"))


def service_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls between customer and supplier nations by order priority.

    ``lineitem`` joins ``orders`` on the order key; the other sides are keyed by
    customer and supplier and joined by key as well, so the planner picks the
    strategy by size. Edges fold map-side in the final ``distinct``.
    """
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    nations = t("nation").select("n_nationkey", "n_name")
    sold = t("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("target_service")
    )
    bought = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("source_service")
    )
    orders = t("orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("scenario")).join(
        bought, "o_custkey"
    )
    # pairs fold to at most nations per order before the larger join
    lines = t("lineitem").join(sold, "l_suppkey").select(F.col("l_orderkey").alias("o_orderkey"), "target_service")
    return (
        lines.join(orders, "o_orderkey")
        .select("scenario", "source_service", "target_service")
        .distinct()
        .withColumn("source_operation", F.concat_ws("_", "source_service", "target_service"))
    )


def placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where("n_nationkey <> 0").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_name").alias("service"), F.col("r_name").alias("node"))


def monitored(spark: SparkSession, sf_dir: str, by_nation: DataFrame | None = None) -> DataFrame:
    """Panel telemetry by scenario, step and service with a system anomaly flag.

    Services are ``svc-<user_id % 8>``, or the names of ``by_nation`` (key,
    service) for ``user_id % 20``.
    """
    data = events(spark, sf_dir)
    if by_nation is None:
        service = F.concat(F.lit("svc-"), (F.col("user_id") % 8).cast("string"))
    else:
        data = data.withColumn("key", (F.col("user_id") % 20).cast("int")).join(by_nation, "key")
        service = F.col("service")
    keyed = data.select(
        F.col("event_type").alias("scenario"), window_of(WINDOW_MICROS).alias("window_id"),
        service.alias("service"), "value", "k",
    )
    keys = ["scenario", "window_id", "service"]
    layout, outer = measure_nested(keyed, ["scenario"], keys)
    sums = keyed.groupBy(*keys).agg(
        F.avg("value").alias("mean_latency"), F.sum("k").alias("cpu_total"),
        F.sum("value").alias("memory_total"), F.count(F.lit(1)).cast("double").alias("net_total"),
        *([] if layout.split else _quantile_aggs()),
    )
    if layout.split:
        wanted = {"p95_latency": ("value", 0.95), "p90_latency": ("value", 0.90)}
        sums = sums.join(exact_quantiles(keyed, layout, wanted), keys)
    # the panel is small next to the events, and every later pass reads it
    panel = reused(sums, "panel")
    steps = panel.withColumns({
        "step": F.col("window_id") - panel.agg(F.min("window_id")).scalar(),
        "resource_pressure": F.col("cpu_total") + F.col("memory_total"),
    })
    last = steps.groupBy("scenario").agg((F.max("step") + 1).alias("steps"))
    early = steps.join(last, "scenario").where(F.col("step") < part_of(F.col("steps"), 0.70))
    limits = exact_quantiles(early, outer, {"limit": ("p95_latency", QUANTILE)})
    return steps.join(limits, "scenario").withColumn(
        "system_anomaly", (F.col("p95_latency") >= F.col("limit")).cast("int")
    ).drop("limit")


def _quantile_aggs() -> list[Column]:
    return [
        F.percentile("value", F.lit(0.95)).alias("p95_latency"),
        F.percentile("value", F.lit(0.90)).alias("p90_latency"),
    ]
