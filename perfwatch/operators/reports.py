"""Monitoring and experiment reports on telemetry, predictions and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.functions.scalars import mapped, zero_if_null
from perfwatch.operators.ordering import measure
from perfwatch.operators.quantile import exact_quantiles

# Labels and lengths of the reports.
SEVERITIES = ["Средняя", "Высокая", "Критическая"]
CRITICAL = "Критическая"
TABLE_STATUSES = ["Передано в отчет", "Проверяется", "Проверяется"]
LOG_STATUSES = ["Передано в отчет", "Проверяется", "Под наблюдением", "Проверяется"]
MODEL_LABELS = {
    "dummy": "Baseline: медианное значение",
    "random_forest": "Random Forest Regressor",
    "hist_gradient_boosting": "HistGradientBoosting Regressor",
}
PERIODS = {
    "Последний час": 12, "Последние 6 часов": 72, "Последние 12 часов": 144, "Все наблюдения": None,
}
DEFAULT_MODEL = "hist_gradient_boosting"
BASE_TIME = "2025-04-10 08:00:00"
STEP_SECONDS = 300
QUANTILE = 0.95


def filter_scenario(df: DataFrame, scenario: str = "all") -> DataFrame:
    return df if scenario == "all" or "scenario" not in df.columns else df.where(F.col("scenario") == scenario)


def filter_services(df: DataFrame, services: list[str] | None = None) -> DataFrame:
    return df.where(F.col("service").isin(services)) if services and "service" in df.columns else df


def filter_period(df: DataFrame, windows: int | None = None) -> DataFrame:
    """The last ``windows`` steps, counted back from the largest step."""
    if windows is None or "step" not in df.columns:
        return df
    return df.where(F.col("step") >= df.agg(F.max("step")).scalar() - windows + 1)


def with_event_time(df: DataFrame) -> DataFrame:
    """Add the notional (zone-free) time of a step; a step that is no number counts as 0."""
    if "event_time" in df.columns:
        return df
    step = "bigint(coalesce(try_cast(step AS DOUBLE), 0D))"
    offset = f"make_dt_interval(0, 0, 0, {step} * {STEP_SECONDS})"
    return df.withColumn("event_time", F.expr(f"TIMESTAMP_NTZ '{BASE_TIME}' + {offset}"))


def _quantile_of(df: DataFrame, column: str, q: float = QUANTILE) -> Column:
    """Exact quantile of a whole frame as a scalar subquery."""
    return exact_quantiles(df, measure(df, []), {"q": (column, q)}).select("q").scalar()


def flagged(df: DataFrame) -> DataFrame:
    """Rows flagged as anomalous, or rows in the top latency quantile without a flag."""
    if "system_anomaly" in df.columns:
        return df.where(F.col("system_anomaly") == 1)
    if "p95_latency" in df.columns:
        return df.where(F.col("p95_latency") >= _quantile_of(df, "p95_latency"))
    return df.limit(0)


def last_rows(df: DataFrame, rows: int, order: list[str]) -> DataFrame:
    """The last rows of a total order (a bounded top-k, not a sort of everything)."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(rows)


def model_quality(metrics: DataFrame, scenario: str = "all") -> DataFrame:
    return (
        filter_scenario(metrics, scenario)
        .select("scenario", mapped(F.col("model"), MODEL_LABELS).alias("model_name"), "split", "mae", "rmse", "r2")
        .orderBy("split", "rmse", "scenario", "model_name")
    )


def test_comparison(metrics: DataFrame, scenario: str = "all", names: tuple[str, ...] = ("rmse", "mae", "r2")) -> DataFrame:
    """Metrics of the test split, one row per scenario and model."""
    return (
        filter_scenario(metrics, scenario)
        .where(F.col("split") == "test")
        .select("scenario", "model", mapped(F.col("model"), MODEL_LABELS).alias("model_label"), *names)
        .orderBy("scenario", "model")
    )


def best_model(metrics: DataFrame, scenario: str = "all") -> DataFrame:
    """One row: the test model with the lowest (RMSE, MAE), or the default."""
    return filter_scenario(metrics, scenario).where(F.col("split") == "test").agg(
        F.coalesce(F.min_by("model", F.struct("rmse", "mae", "model")), F.lit(DEFAULT_MODEL)).alias("best_model")
    )


def risk_windows(df: DataFrame, scenario: str = "all", services: list[str] | None = None) -> DataFrame:
    data = filter_services(filter_scenario(df, scenario), services)
    kept = ["scenario", "step", "window_id", "service", "p95_latency", "cpu_total", "memory_total", "net_total", "system_anomaly"]
    risks = flagged(data)
    risks = risks.select(*[c for c in kept if c in risks.columns])
    return risks.orderBy(*[c for c in ("scenario", "step", "service") if c in risks.columns])


def predictions_of(predictions: DataFrame, scenario: str, model: str) -> DataFrame:
    return filter_scenario(predictions.where(F.col("model") == model), scenario)


def kpi_row(
    telemetry: DataFrame, predictions: DataFrame, metrics: DataFrame, services: DataFrame,
    scenario: str, model: str,
) -> DataFrame:
    """One row of headline numbers; each source is aggregated once.

    Over all scenarios the metrics row is the one of scenario ``all`` if there
    is one and else the first by name, and the forecast is the last one of the
    last scenario.
    """
    quality = filter_scenario(metrics.where((F.col("model") == model) & (F.col("split") == "test")), scenario)
    first = F.struct(F.col("scenario") != "all", F.col("scenario"))
    quality = quality.agg(F.struct(F.min_by("rmse", first).alias("rmse"), F.min_by("r2", first).alias("r2")).alias("m"))
    forecast = predictions_of(predictions, scenario, model).agg(
        F.max_by("y_pred", F.struct("scenario", "step"))
    )
    return (
        filter_scenario(telemetry, scenario)
        .agg(
            F.count_distinct("step").alias("windows"),
            zero_if_null(F.avg("system_anomaly") * 100).alias("risk_share"),
        )
        .withColumns({
            "_m": quality.scalar(),
            "forecast_p95": zero_if_null(forecast.scalar()),
            "service_count": services.agg(F.count(F.lit(1))).scalar(),
        })
        .select(
            F.lit(model).alias("model"), "service_count", "windows", "risk_share", "forecast_p95",
            zero_if_null(F.col("_m.rmse")).alias("rmse"), zero_if_null(F.col("_m.r2")).alias("r2"),
        )
    )


def realtime_series(df: DataFrame, metrics: list[str], last: int = 220) -> DataFrame:
    """Mean of each metric by step, for the last steps."""
    means = df.groupBy("step").agg(*[F.avg(m).alias(m) for m in metrics])
    return last_rows(means, last, ["step"])


def min_max_scaled(series: DataFrame, columns: list[str]) -> DataFrame:
    """Scale each column of a short series to [0, 1]; a constant column becomes 0.

    The series is bounded (at most the steps on show), so one window holds it.
    """
    whole = Window.partitionBy()

    def scaled(name: str) -> Column:
        low, high = F.min(name).over(whole), F.max(name).over(whole)
        return F.when(high != low, (F.col(name) - low) / F.nullif(high - low, F.lit(0.0))).otherwise(F.lit(0.0))

    return series.withColumns({c: scaled(c) for c in columns})


def forecast_series(
    predictions: DataFrame, scenario: str, model: str, raw: DataFrame | None = None, last: int = 220
) -> DataFrame:
    """Forecasts at the step they are for; scaled by the range of raw p95 if given."""
    shown = last_rows(predictions_of(predictions, scenario, model), last, ["step", "scenario"])
    shifted = shown.select("scenario", (F.col("step") + 1).alias("step"), "y_pred")
    if raw is None:
        return shifted.withColumn("y_pred_display", F.col("y_pred"))
    span = raw.agg(F.struct(F.min("p95_latency").alias("low"), F.max("p95_latency").alias("high")))
    ranged = shifted.withColumn("_r", span.scalar())
    low, high = F.col("_r.low"), F.col("_r.high")
    value = (F.col("y_pred") - low) / F.nullif(high - low, F.lit(0.0))
    return ranged.withColumn("y_pred_display", F.when(high != low, value).otherwise(F.lit(0.0))).drop("_r")


def realtime_with_forecast(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """Observed series and forecast on one step axis."""
    return series.join(forecast.select("step", "y_pred_display"), "step", "full")


def forecast_vs_actual(predictions: DataFrame, scenario: str, model: str, last: int = 600) -> DataFrame:
    rows = last_rows(predictions_of(predictions, scenario, model), last, ["scenario", "step"])
    return rows.select("scenario", "step", "y_true", "y_pred")


def scaled_by_maximum(df: DataFrame, columns: list[str], order: list[str], last: int = 800) -> DataFrame:
    """The last rows with each column divided by its maximum; a zero maximum changes nothing."""
    whole = Window.partitionBy()  # over the bounded tail
    tail = last_rows(df.select(*order, *columns), last, order)
    return tail.withColumns({
        c: F.coalesce(F.try_divide(F.col(c), F.nullif(F.max(c).over(whole), F.lit(0.0))), F.col(c))
        for c in columns
    })


def severity(value: Column, over: Window | None = None) -> Column:
    """Three right-closed bins of equal width over the kept rows; equal values fall in the middle."""
    whole = over or Window.partitionBy()
    low, high = F.min(value).over(whole), F.max(value).over(whole)
    width = (high - low) / F.lit(3.0)
    return (
        F.when(value.isNull(), F.lit(None))
        .when(low == high, F.lit(SEVERITIES[1]))
        .when(value <= low + width, F.lit(SEVERITIES[0]))
        .when(value <= low + width * 2, F.lit(SEVERITIES[1]))
        .otherwise(F.lit(SEVERITIES[2]))
    )


def round_robin(index: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index % len(labels) + 1).cast("int"))


def incidents(
    df: DataFrame,
    order: list[str],
    fallback: int = 20,
    keep: int = 80,
    statuses: list[str] = LOG_STATUSES,
) -> DataFrame:
    """Incident log: the last flagged rows, or the slowest rows if none is flagged.

    Both branches end in a bounded top-k, so the choice between them, the
    severity bins and the status cycle run on at most ``keep + fallback`` rows.
    """
    data = with_event_time(df)
    tie = [F.desc(c) for c in order]
    risky = flagged(data).orderBy(*tie).limit(keep).withColumn("_rank", F.lit(1))
    slowest = data.orderBy(F.desc("p95_latency"), *tie).limit(fallback).withColumn("_rank", F.lit(0))
    best = F.max("_rank").over(Window.partitionBy())
    chosen = risky.unionByName(slowest).withColumn("_best", best).where("_rank = _best")
    kept = last_rows(chosen, keep, order)
    place = F.row_number().over(Window.partitionBy().orderBy(*order)) - 1
    columns = ["scenario", "step", "event_time", "window_id", "service", "p95_latency", "cpu_total", "memory_total", "net_total"]
    return kept.withColumns({
        "severity": severity(F.col("p95_latency")), "status": round_robin(place, statuses),
    }).select(*[c for c in columns if c in kept.columns], "severity", "status")


def report_data(
    df: DataFrame, scenario: str = "all", windows: int | None = None,
    services: list[str] | None = None, only_critical: bool = False,
) -> DataFrame:
    """Filters, the incident log, and only then the critical filter."""
    data = filter_services(filter_period(filter_scenario(df, scenario), windows), services)
    log = incidents(data, ["event_time", "service", "scenario"])
    return log.where(F.col("severity") == CRITICAL) if only_critical else log


def operational_summary(log: DataFrame, period: str, service_count: int) -> DataFrame:
    """One row of report totals; an empty log gives zeros and ``-``."""
    return log.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("severity") == CRITICAL).alias("critical_count"),
        zero_if_null(F.avg((F.col("severity") == CRITICAL).cast("double")) * 100).alias("critical_share"),
        zero_if_null(F.avg("p95_latency")).alias("mean_p95"),
        F.coalesce(F.max_by("service", F.struct("p95_latency", "service")), F.lit("-")).alias("peak_service"),
    ).select(F.lit(period).alias("period"), "*", F.lit(service_count).alias("service_count"))


def summary_rows(summary: DataFrame) -> DataFrame:
    """The summary as (indicator, value) text rows for export."""
    # Row titles of the exported summary.
    titles = {
        "period": "Период отчета",
        "event_count": "Количество риск-событий",
        "critical_count": "Критических событий",
        "critical_share": "Доля критических событий",
        "mean_p95": "Средняя p95 latency",
        "peak_service": "Сервис с максимальным пиком",
        "service_count": "Количество сервисов в отчете",
    }
    text = {
        "critical_share": F.concat(F.format_number("critical_share", 1), F.lit(" %")),
        "mean_p95": F.replace(F.format_number("mean_p95", 0), F.lit(","), F.lit(" ")),
    }
    cells = [
        F.struct(F.lit(title).alias("indicator"), text.get(c, F.col(c).cast("string")).alias("value"))
        for c, title in titles.items()
    ]
    return summary.select(F.inline(F.array(*cells)))


def incident_trend(log: DataFrame) -> DataFrame:
    """Events by ``HH:mm`` and severity, zeros included; the date is dropped on purpose."""
    counts = log.groupBy(F.date_format("event_time", "HH:mm").alias("time_bucket")).agg(*[
        F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES
    ])
    return counts.unpivot("time_bucket", SEVERITIES, "severity", "events")


def service_peaks(log: DataFrame, top: int = 10) -> DataFrame:
    peaks = log.groupBy("service").agg(F.max("p95_latency").alias("p95_latency"))
    return peaks.orderBy(F.desc("p95_latency"), "service").limit(top)


def status_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def experiment_overview(samples: DataFrame, roles: DataFrame) -> DataFrame:
    """One row: samples, complete samples, files, scenario list."""
    return samples.agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count_if("is_complete_for_training").alias("complete_count"),
        F.array_join(F.sort_array(F.collect_set("scenario")), ", ").alias("scenarios"),
    ).withColumn("file_count", F.coalesce(roles.agg(F.sum("file_count")).scalar(), F.lit(0)))


def integrity_table(samples: DataFrame) -> DataFrame:
    return samples.select("logical_sample_key", "has_train", "has_val", "has_test", "is_complete_for_training")
