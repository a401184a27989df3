"""Scalar expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_EPS = 1e-9


def finite(value: Column) -> Column:
    """Number or NULL: text that is no number, NaN and infinities become NULL."""
    number = value.try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), F.lit(None)).otherwise(number)


def finite_sql(name: str) -> str:
    """``finite`` of a column as SQL text."""
    number = f"try_cast(`{name}` AS DOUBLE)"
    return f"CASE WHEN isnan({number}) OR abs({number}) = double('Infinity') THEN NULL ELSE {number} END"


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def safe_ratio_sql(num: str, den: str) -> str:
    """``num / (den + eps)`` as SQL text; a zero or missing denominator or numerator gives 0."""
    return f"coalesce(try_divide({num}, nullif({den}, 0D) + {RATIO_EPS!r}D), 0D)"


def part_of(rows: Column, fraction: float) -> Column:
    """``int(rows * fraction)`` in double arithmetic (a bare literal would be a decimal)."""
    return F.floor(rows.cast("double") * F.lit(float(fraction)))


def mapped(value: Column, labels: dict[str, str]) -> Column:
    """Display label of a code; unknown codes pass through."""
    if not labels:
        return value
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)
