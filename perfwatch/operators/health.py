"""Source health: one row per sample and rule, judged from the data itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfwatch.operators.families import RESOURCE_FAMILIES

# States of a source.
NORMAL, DEGRADED, FAILED, ANALYSE = "Норма", "Деградация", "Ошибка", "Требует анализа"
ERROR_GROWTH = 1.5


def _rule(name: str, bad: Column, state: str) -> Column:
    return F.struct(F.lit(name).alias("rule"), F.when(bad, F.lit(state)).otherwise(F.lit(NORMAL)).alias("state"))


def source_health(samples: DataFrame, min_rows: int = 10, growth: float = ERROR_GROWTH) -> DataFrame:
    """Rules over one row per sample.

    ``samples`` has ``rows``, ``<family>_available``, ``is_complete`` (manifest),
    ``is_readable`` and ``val_rmse``/``test_rmse``; an unknown value passes.
    """
    def is_false(column: str) -> Column:
        return ~F.coalesce(F.col(column), F.lit(True))

    rules = [
        _rule(f"{family}_missing", F.col(f"{family}_available") == 0, DEGRADED) for family in RESOURCE_FAMILIES
    ]
    rules += [
        _rule("too_few_rows", F.col("rows") < min_rows, FAILED),
        _rule("unreadable_file", is_false("is_readable"), FAILED),
        _rule("not_in_manifest", is_false("is_complete"), FAILED),
        _rule("error_growth", F.col("test_rmse") > F.col("val_rmse") * growth, ANALYSE),
    ]
    return samples.select("sample_key", F.inline(F.array(*rules)))
