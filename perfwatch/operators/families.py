"""Column families of wide telemetry: discovery, numeric gate, unpivot, lineage."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.functions.scalars import finite
from perfwatch.operators.ordering import join_on

# How service columns are named.
SERVICE_COLUMN = r"^(\d+)_(.+)$"
EXACT_FAMILIES = {"latency": "latency", "start": "start"}
RESOURCE_FAMILIES = {
    "cpu": ["container_cpu_usage_seconds_total"],
    "memory": ["container_memory_usage_bytes"],
    "net_rx": ["container_network_receive_bytes_total"],
    "net_tx": ["container_network_transmit_bytes_total"],
}
PASSTHROUGH = ["trace_id", "label_trace"]


def _service_columns(names: list[str], accept) -> list[str]:
    """Names accepted by ``accept(metric, full_name)``, by service id and then by name."""
    parsed = [(re.match(SERVICE_COLUMN, n), n) for n in names]
    kept = [(int(m.group(1)), n) for m, n in parsed if m and accept(m.group(2), n)]
    return [n for _, n in sorted(kept)]


def exact_columns(df: DataFrame, metric: str) -> list[str]:
    """Columns ``<digits>_<metric>`` (exact and case-sensitive)."""
    return _service_columns(df.columns, lambda found, _: found == metric)


def token_columns(df: DataFrame, tokens: list[str], numeric_only: bool = True) -> list[str]:
    """Service columns whose name contains all tokens, whatever the case."""
    numeric = set(numeric_columns(df)) if numeric_only else set(df.columns)
    wanted = [t.lower() for t in tokens]
    return [
        n
        for n in _service_columns(df.columns, lambda _, name: all(t in name.lower() for t in wanted))
        if n in numeric
    ]


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Number and boolean columns in schema order."""
    skipped = set(exclude or [])
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in skipped
    ]


def family_columns(df: DataFrame, numeric_only: bool = True) -> dict[str, list[str]]:
    found = {family: exact_columns(df, metric) for family, metric in EXACT_FAMILIES.items()}
    for family, tokens in RESOURCE_FAMILIES.items():
        found[family] = token_columns(df, tokens, numeric_only)
    return found


def mark_available(df: DataFrame) -> DataFrame:
    """Add ``<family>_available``: 1 if the header has a column of the family.

    Applied per header group, before groups of different headers are united.
    """
    found = family_columns(df, numeric_only=False)
    flags = {
        f"{family}_available": F.lit(1 if cols else 0)
        for family, cols in found.items()
        if f"{family}_available" not in df.columns
    }
    return df.withColumns(flags) if flags else df


def gate_resources(df: DataFrame, key: str) -> DataFrame:
    """Type resource columns read as text.

    A resource column with one cell that is no number is dropped for its whole
    sample; latency and start columns are coerced cell by cell. One
    pre-aggregated pass counts the bad cells per sample.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    found = family_columns(df, numeric_only=False)
    resource = [c for family in RESOURCE_FAMILIES for c in found[family] if c in text]
    exact = [c for family in EXACT_FAMILIES for c in found[family] if c in text]
    typed = df.withColumns({c: F.col(c).try_cast("double") for c in exact}) if exact else df
    if not resource:
        return typed
    bad = df.groupBy(key).agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"_bad_{c}")
        for c in resource
    ])
    joined = join_on(typed, bad, [key])
    values = {c: F.when(F.col(f"_bad_{c}") == 0, F.col(c).try_cast("double")) for c in resource}
    flags = {}
    for family in RESOURCE_FAMILIES:
        cols = [c for c in found[family] if c in text]
        if cols:
            usable = reduce(or_, [F.col(f"_bad_{c}") == 0 for c in cols])
            old = F.col(f"{family}_available") if f"{family}_available" in df.columns else F.lit(1)
            flags[f"{family}_available"] = F.when(usable, old).otherwise(F.lit(0))
    return joined.withColumns({**values, **flags}).drop(*[f"_bad_{c}" for c in resource])


def coerce(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text, NaN and infinities in ``columns`` become NULL."""
    return df.withColumns({c: finite(F.col(c)) for c in columns})


def to_long(df: DataFrame, ids: list[str], keep_nulls: bool = False) -> DataFrame:
    """Wide service columns to ``(ids, service_id, family, value)`` rows."""
    found = family_columns(df)
    family_of = {c: family for family, cols in found.items() for c in cols}
    clean = df.select(*ids, *[finite(F.col(c)).alias(c) for c in family_of])
    long = clean.unpivot(ids, list(family_of), "column_name", "value")
    if not keep_nulls:
        long = long.where("value is not null")
    names = [F.lit(x) for pair in family_of.items() for x in pair]
    return long.select(
        *ids,
        F.regexp_extract("column_name", SERVICE_COLUMN, 1).cast("int").alias("service_id"),
        F.element_at(F.create_map(*names), F.col("column_name")).alias("family"),
        "value",
    )


def lineage(relpath: Column) -> dict[str, Column]:
    """File name, relative path and the first three path parts (``''`` if missing)."""
    parts = F.split(relpath, "/")
    levels = {f"source_level_{i + 1}": F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i in range(3)}
    return {"source_file": F.element_at(parts, -1), "source_relpath": relpath, **levels}
