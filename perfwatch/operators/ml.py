"""Distributed training, scoring and persistence of next-step models."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.columns import feature_columns
from perfwatch.operators.evaluate import classification_metrics, regression_metrics, roc_auc
from perfwatch.operators.ordering import Layout, measure
from perfwatch.operators.quantile import exact_quantiles

BASELINE = "dummy"
MODELS = (BASELINE, "random_forest", "hist_gradient_boosting")


def medians_of(rows: DataFrame, columns: list[str], layout: Layout | None = None) -> dict[str, float | None]:
    """The exact median of each column; None for one without values."""
    found = exact_quantiles(rows, layout or measure(rows, []), {c: (c, 0.5) for c in columns}).first()
    return found.asDict()


def median_impute(df: DataFrame, columns: list[str], fit_rows: Column, layout: Layout | None = None) -> DataFrame:
    """Replace NULLs by the exact median of the ``fit_rows``.

    A column without any value among the fit rows is dropped.
    """
    medians = medians_of(df.where(fit_rows).select(*columns), columns, layout)
    kept = [c for c in columns if medians[c] is not None]
    gone = [c for c in columns if medians[c] is None]
    return df.drop(*gone).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in kept})


def majority_class(df: DataFrame, target: str) -> DataFrame:
    """One row: the most frequent class; ties go to the smallest."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("int").alias("y")).count()
    return counts.orderBy(F.desc("count"), "y").limit(1).select(F.col("y").alias("majority"))


def target_median(df: DataFrame, target: str) -> DataFrame:
    """One row: the exact median of the target."""
    rows = df.select(target)
    return exact_quantiles(rows, measure(rows, []), {"median": (target, 0.5)})


def forest_regressor(seed: int = 42, trees: int = 120) -> Estimator:
    return RandomForestRegressor(
        labelCol="y_true", numTrees=trees, maxDepth=14, minInstancesPerNode=3, seed=seed
    )


def boosting_regressor(seed: int = 42, rounds: int = 180) -> Estimator:
    """Spark ML trees have no leaf cap and no L2 term; depth 5 is at most 32 leaves."""
    return GBTRegressor(labelCol="y_true", maxIter=rounds, stepSize=0.06, maxDepth=5, seed=seed)


def forest_classifier(seed: int = 42, trees: int = 160) -> Estimator:
    return RandomForestClassifier(
        labelCol="y_true", weightCol="weight", numTrees=trees, maxDepth=14, minInstancesPerNode=3, seed=seed
    )


def boosting_classifier(seed: int = 42, rounds: int = 180) -> Estimator:
    return GBTClassifier(labelCol="y_true", maxIter=rounds, stepSize=0.06, maxDepth=5, seed=seed)


ESTIMATORS = {
    "regression": {"random_forest": forest_regressor, "hist_gradient_boosting": boosting_regressor},
    "classification": {"random_forest": forest_classifier, "hist_gradient_boosting": boosting_classifier},
}


@dataclass
class Prepared:
    """Rows with ``features``, ``y_true``, ``split`` and ``weight``, and the fitted preparation."""

    rows: DataFrame
    stages: list[Transformer]
    features: list[str]


@dataclass
class Trained:
    """Fitted models, metrics per model and split, and test predictions per model."""

    metrics: DataFrame
    predictions: DataFrame
    models: dict[str, PipelineModel] = field(default_factory=dict)
    cached: DataFrame | None = None
    features: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Free the assembled rows once metrics and predictions are stored."""
        if self.cached is not None:
            self.cached.unpersist()


def prepare(dataset: DataFrame, target: str, task: str) -> Prepared:
    """Features of the train split: numeric, not all NULL, median-imputed, assembled.

    ``dataset`` is flat (see ``flatten_lags``) and has ``split``.
    """
    names = feature_columns(dataset, target)
    y = F.col(target).cast("int" if task == "classification" else "double").cast("double")
    typed = dataset.withColumn("y_true", y).selectExpr("split", "y_true", *[f"double(`{c}`) AS `{c}`" for c in names])
    train = typed.where("split = 'train'")
    # exact; a column without values has none
    medians = medians_of(train.select(*names), names) if names else {}
    features = [c for c in names if medians[c] is not None]
    filled = ", ".join(f"coalesce(`{c}`, {float(medians[c])!r}D) AS `{c}__filled`" for c in features)
    pipeline = PipelineModel([
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}__filled" for c in features], outputCol="features"),
    ])
    assembled = pipeline.transform(typed).select("split", "y_true", "features")
    if task == "classification":
        counts = {r["y_true"]: r["count"] for r in train.groupBy("y_true").count().collect()}
        total = sum(counts.values())
        weights = [F.when(F.col("y_true") == k, F.lit(total / (2.0 * n))) for k, n in counts.items()]
        assembled = assembled.withColumn("weight", F.coalesce(*weights, F.lit(1.0)))
    return Prepared(assembled, pipeline.stages, features)


def score(model: Model, rows: DataFrame, task: str) -> DataFrame:
    """``split, y_true, y_pred`` and, for classes, the probability of the positive one."""
    scored = model.transform(rows)
    if task == "regression":
        return scored.select("split", "y_true", F.col("prediction").alias("y_pred"))
    probability = F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.col("prediction"))
    return scored.select(
        "split", F.col("y_true").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
        probability.alias("anomaly_probability"),
    )


def baseline(dataset: DataFrame, target: str, task: str) -> DataFrame:
    """Constant predictions learned on the train split: the median or the commonest class."""
    train = dataset.where("split = 'train'")
    if task == "regression":
        value = target_median(train, target).scalar()
        return dataset.select("split", F.col(target).cast("double").alias("y_true"), value.alias("y_pred"))
    value = majority_class(train, target).scalar()
    return dataset.select("split", F.col(target).cast("int").alias("y_true"), value.alias("y_pred")).withColumn(
        "anomaly_probability", F.col("y_pred").cast("double")
    )


def metrics_of(predictions: DataFrame, task: str, keys: list[str]) -> DataFrame:
    if task == "regression":
        return regression_metrics(predictions, keys)
    return classification_metrics(predictions, keys).join(roc_auc(predictions, keys), keys, "left")


def train_and_evaluate(
    dataset: DataFrame, target: str, task: str, models: tuple[str, ...] = MODELS, seed: int = 42,
    **sizes: int,
) -> Trained:
    """Fit the models on train; metrics on the three splits; keep test predictions.

    The assembled rows are persisted while the models are fitted, and all
    metrics come from one pass over the united predictions.
    """
    scored: dict[str, DataFrame] = {}
    fitted: dict[str, PipelineModel] = {}
    if BASELINE in models:
        scored[BASELINE] = baseline(dataset, target, task)
    wanted = [m for m in models if m != BASELINE]
    rows, features = None, []
    if wanted:
        prepared = prepare(dataset, target, task)
        rows, features = prepared.rows.persist(), prepared.features
        for name in wanted:
            estimator = ESTIMATORS[task][name](seed, *[sizes[name]] if name in sizes else [])
            model = estimator.fit(rows.where("split = 'train'"))
            fitted[name] = PipelineModel([*prepared.stages, model])
            scored[name] = score(model, rows, task)
    united = reduce(DataFrame.unionByName, [p.withColumn("model", F.lit(m)) for m, p in scored.items()])
    return Trained(metrics_of(united, task, ["model", "split"]), united.where("split = 'test'"), fitted, rows, features)


def save_models(models: dict[str, PipelineModel], root: str, task: str, scenario: str) -> dict[str, str]:
    paths = {name: f"{root}/models/{task}/{scenario}/{name}" for name in models}
    for name, model in models.items():
        model.write().overwrite().save(paths[name])
    return paths


def apply_saved(path: str, dataset: DataFrame, target: str, task: str) -> DataFrame:
    """Score rows with a stored pipeline, which imputes and assembles by itself."""
    names = feature_columns(dataset, target)
    typed = dataset.selectExpr("split", f"double(`{target}`) AS y_true", *[f"double(`{c}`) AS `{c}`" for c in names])
    return score(PipelineModel.load(path), typed, task)
