"""Permutation importance: how much a model's error grows when a feature's values are dealt out anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.ordering import in_order, measure, positions


def permutation_importance(
    rows: DataFrame, features: list[str], target: str, identity: list[Column | str], score: Callable[[DataFrame], DataFrame], seed: int = 42
) -> DataFrame:
    """(feature, importance): growth of the mean absolute error when the feature comes from another row.

    Rows are put in the order of a hash of ``identity`` (unique per row) and
    the seed; each takes the value of the next one, the last that of the first.
    All features are scored in one pass: a row is repeated once for each, with
    one value replaced, and once unchanged. ``score`` adds ``y_pred`` from the
    array column ``values``. Ties of the hash go by ``identity``. No rows give
    no result.
    """
    ids = [F.col(c) if isinstance(c, str) else c for c in identity]
    keyed = rows.select(
        F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("values"), F.col(target).cast("double").alias("y_true"),
        *[c.alias(f"_id{i}") for i, c in enumerate(ids)],
    ).withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"_id{i}").cast("string") for i in range(len(ids))])))
    layout = measure(keyed, [])
    placed = positions(keyed, layout, ["_hash", *[f"_id{i}" for i in range(len(ids))]], "_place")
    following = in_order(placed, layout, "_place", 0, 1, lambda w: {"_next": F.lead("values", 1).over(w)})
    first = placed.where("_place = 0").select("values").scalar()
    dealt = following.withColumn("_other", F.coalesce("_next", first)).select(
        "y_true", "values", "_other", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("_at")
    )
    replaced = F.transform("values", lambda x, i: F.when(i == F.col("_at"), F.element_at("_other", F.col("_at") + 1)).otherwise(x))
    changed = dealt.select("y_true", "_at", F.when(F.col("_at") < 0, F.col("values")).otherwise(replaced).alias("values"))
    errors = score(changed).groupBy("_at").agg(F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("error"))
    base = errors.where("_at < 0").select("error").scalar()
    names = F.array(*map(F.lit, features))
    return errors.where("_at >= 0").select(
        F.element_at(names, F.col("_at") + 1).alias("feature"), (F.col("error") - base).alias("importance")
    )


def model_score(model: Model) -> Callable[[DataFrame], DataFrame]:
    """``score`` of a fitted Spark ML model over the assembled features."""
    def score(rows: DataFrame) -> DataFrame:
        scored = model.transform(rows.withColumn("features", array_to_vector("values")))
        return scored.withColumnRenamed("prediction", "y_pred")

    return score
