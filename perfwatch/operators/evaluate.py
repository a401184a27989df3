"""Exact regression and classification metrics of prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.functions.scalars import zero_if_null
from perfwatch.operators.ordering import Layout, by_group_size, in_order, join_on, measure, positions, running_total
from perfwatch.operators.validation import require_columns

HIGH_RISK = 0.8


def regression_metrics(df: DataFrame, keys: list[str], truth: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """MAE, RMSE and R² per group in one pass.

    With constant truth R² is 1 for perfect predictions and else 0; it is
    undefined (NULL) for fewer than two rows.
    """
    y = F.col(truth).cast("double")
    error = F.col(pred).cast("double") - y
    sums = df.groupBy(*keys).agg(
        F.count(error).alias("row_count"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
    )
    r2 = (
        F.when(F.col("row_count") < 2, F.lit(None))
        .when(F.col("_sst") > 0, F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst")))
        .when(F.col("_sse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return sums.withColumn("r2", r2).drop("_sse", "_sst")


def confusion(df: DataFrame, keys: list[str], truth: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """The four cells of the binary confusion matrix per group."""
    y, p = F.col(truth).cast("int"), F.col(pred).cast("int")
    return df.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return zero_if_null(F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0))))


def classification_metrics(
    df: DataFrame, keys: list[str], truth: str = "y_true", pred: str = "y_pred"
) -> DataFrame:
    """Accuracy, precision, recall and F1 per group; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, keys, truth, pred).select(
        *keys,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(
    df: DataFrame, keys: list[str], truth: str = "y_true", score: str = "anomaly_probability",
    layout: Layout | None = None,
) -> DataFrame:
    """Tie-aware area under the ROC curve per group; NULL if one class is missing.

    Rows are first counted per distinct score, so only distinct scores are
    ordered; the running count of negatives works on groups of any size.
    """
    layout = layout or measure(df, keys)
    counts = df.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("_score")).agg(
        F.count_if(F.col(truth).cast("int") == 1).alias("_pos"),
        F.count_if(F.col(truth).cast("int") != 1).alias("_neg"),
    )
    ordered = running_total(counts, layout, ["_score"], "_neg", "_neg_upto")
    # a positive beats every negative below its score and half of those at it
    wins = F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") / F.lit(2.0))
    return ordered.groupBy(*keys).agg(
        F.try_divide(
            F.sum(wins), F.nullif(F.sum("_pos").cast("double") * F.sum("_neg").cast("double"), F.lit(0.0))
        ).alias("roc_auc")
    )


def roc_curve(
    df: DataFrame, keys: list[str], truth: str = "y_true", score: str = "anomaly_probability",
    layout: Layout | None = None,
) -> DataFrame:
    """Corner points of the ROC curve per group: threshold, tp, fp, tpr, fpr, from (0, 0) with a NULL threshold.

    One point for each distinct score; a point on the line between its
    neighbours is left out. A rate is NULL if its class is missing.
    """
    counts = df.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(truth).cast("int") == 1).alias("_pos"), F.count_if(F.col(truth).cast("int") != 1).alias("_neg")
    )
    totals = counts.groupBy(*keys).agg(F.sum("_pos").alias("_all_pos"), F.sum("_neg").alias("_all_neg"))
    points = _corners(counts, layout or measure(df, keys))
    origin = totals.select(*keys, F.lit(None).cast(df.schema[score].dataType).alias("threshold"), *[F.lit(0).cast("bigint").alias(c) for c in ("tp", "fp")])
    rates = {"tpr": F.try_divide(F.col("tp").cast("double"), F.col("_all_pos")), "fpr": F.try_divide(F.col("fp").cast("double"), F.col("_all_neg"))}
    return join_on(points.unionByName(origin), totals, keys).withColumns(rates).drop("_all_pos", "_all_neg")


@by_group_size
def _corners(counts: DataFrame, layout: Layout) -> DataFrame:
    """Running counts from the highest score down, where the next step turns."""
    placed = positions(counts, layout, [F.col("threshold").desc()], "_place")
    ahead = in_order(placed, layout, "_place", 0, 1, lambda w: {"_next": F.lead(F.struct("_pos", "_neg"), 1).over(w)})
    rising = running_total(ahead, layout, ["_place"], "_pos", "tp")
    both = running_total(rising, layout, ["_place"], "_neg", "fp")
    straight = F.col("_pos") * F.col("_next._neg") == F.col("_neg") * F.col("_next._pos")
    return both.where(F.col("_next").isNull() | ~straight).select(*layout.keys, "threshold", "tp", "fp")


def evaluate_predictions(df: DataFrame, keys: list[str], layout: Layout | None = None) -> DataFrame:
    """Classification metrics and ROC-AUC, one row per prediction file (or other group)."""
    require_columns(df, ["y_true", "y_pred"], "Prediction table")
    metrics = classification_metrics(df, keys)
    if "anomaly_probability" not in df.columns:
        return metrics.withColumn("roc_auc", F.lit(None).cast("double"))
    return join_on(metrics, roc_auc(df, keys, layout=layout), keys, "left")


def positive_share(df: DataFrame, keys: list[str], target: str) -> DataFrame:
    return df.groupBy(*keys).agg(zero_if_null(F.avg(F.col(target).cast("double"))).alias("positive_share_train"))


def prediction_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, mean error, mean absolute error, mean probability, high-risk count."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if {"y_true", "y_pred"} <= set(df.columns):
        error = F.col("y_pred").try_cast("double") - F.col("y_true").try_cast("double")
        aggs += [F.avg(error).alias("mean_error"), F.avg(F.abs(error)).alias("mean_abs_error")]
    if "anomaly_probability" in df.columns:
        p = F.col("anomaly_probability").try_cast("double")
        aggs += [
            F.avg(p).alias("mean_anomaly_probability"),
            F.count_if(p >= HIGH_RISK).alias("high_risk_count_0_8"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def metrics_document(metrics: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Nest metric rows as ``models: map<model, map<split, struct>>`` per group.

    The groups are runs: a handful of models and three splits each.
    """
    by_split = metrics.groupBy(*keys, "model").agg(
        F.map_from_entries(F.collect_list(F.struct("split", F.struct(*names)))).alias("splits")
    )
    return by_split.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("model", "splits"))).alias("models")
    )


def flatten_metrics(documents: DataFrame, keys: list[str]) -> DataFrame:
    """Nested training metrics to one row per (task, scenario, model, split)."""
    models = documents.select(*keys, F.explode("models").alias("model", "splits"))
    splits = models.select(*keys, "model", F.explode("splits").alias("split", "values"))
    return splits.select(*keys, "model", "split", "values.*")
