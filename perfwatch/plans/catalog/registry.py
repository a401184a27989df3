"""Registry of queries; importing the sibling modules fills it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
_MODULES = ["telemetry", "files", "learning", "monitoring"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"Query {name} is registered twice.")
        _queries[name] = function
        if sql is not None:
            _oracles[name] = sql
        return function

    return add


def snapped(df: DataFrame) -> DataFrame:
    """Comparable form of a result: integers as long, doubles snapped to a 1e-6 grid.

    The grid is shifted so that its ties lie off the decimal grid: engines
    differ in the last bits, and short decimals would flip at ties.
    """
    def out(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType):
            return f"floor({name} * 1e6D + 0.3183D) / 1e6D AS {name}"
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"bigint({name}) AS {name}"
        return name

    return df.selectExpr(*[out(f) for f in df.schema.fields])


def snap(expression: str, name: str | None = None) -> str:
    """The same snapping in the SQL of the oracle."""
    name = name or expression
    return f"floor(({expression}) * 1e6::DOUBLE + 0.3183::DOUBLE) / 1e6::DOUBLE AS {name}"


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"perfwatch.plans.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
