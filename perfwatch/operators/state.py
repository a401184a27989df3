"""System state: one row per observation window from wide service columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.functions import rowstats as rs
from perfwatch.functions.scalars import finite_sql, safe_ratio_sql, zero_if_null
from perfwatch.operators.families import PASSTHROUGH, RESOURCE_FAMILIES, family_columns
from perfwatch.operators.ordering import Layout, join_on
from perfwatch.operators.quantile import exact_quantiles

QUANTILES = {"p50_latency": 0.50, "p90_latency": 0.90, "p95_latency": 0.95}
LATENCY_COLUMNS = [
    *QUANTILES, "mean_latency", "max_latency", "min_latency", "std_latency", "latency_service_count",
]
START_COLUMNS = ["mean_start", "max_start", "min_start", "std_start", "span_start"]
RESOURCE_STATS = ["total", "max", "mean", "std", "service_count"]
RATIO_COLUMNS = [f"latency_to_{family}_ratio" for family in RESOURCE_FAMILIES]
SUM_COLUMNS = {"resource_pressure": ("cpu", "memory"), "net_total": ("net_rx", "net_tx")}
SOURCE_COLUMNS = ["source_file", "source_relpath", "source_level_1", "source_level_2", "source_level_3"]


def present(*families: str) -> str:
    """SQL test: the header of the sample had a column of each family."""
    return " AND ".join(f"{family}_available = 1" for family in families)


def when_present(families: tuple[str, ...], value: str) -> str:
    return f"CASE WHEN {present(*families)} THEN {value} END"


def families_of(column: str) -> tuple[str, ...]:
    """The families a state column needs in order to exist."""
    if column in SUM_COLUMNS:
        return SUM_COLUMNS[column]
    if column in RATIO_COLUMNS:
        return ("latency", column.removeprefix("latency_to_").removesuffix("_ratio"))
    if column in LATENCY_COLUMNS:
        return ("latency",)
    if column in START_COLUMNS:
        return ("start",)
    for family in RESOURCE_FAMILIES:
        if column in {f"{family}_{stat}" for stat in RESOURCE_STATS}:
            return (family,)
    raise KeyError(column)


def state_columns() -> list[str]:
    """All state columns of the superset schema, without the dynamics."""
    resources = [
        f"{family}_{stat}" for family in RESOURCE_FAMILIES for stat in (*RESOURCE_STATS, "available")
    ]
    return [*LATENCY_COLUMNS, *START_COLUMNS, *resources, *RATIO_COLUMNS, *SUM_COLUMNS]


def system_state(df: DataFrame, keys: tuple[str, ...] = ("sample_key", "seq")) -> DataFrame:
    """Row-wise aggregation across the services of each window; no shuffle.

    Columns of a family that the header lacks stay NULL; values are not yet
    zero-filled, because the dynamics need the gaps (see ``fill_state``).
    """
    have = df.columns
    found = family_columns(df)
    ids = [k for k in keys if k in have]
    carried = [c for c in (*PASSTHROUGH, *SOURCE_COLUMNS) if c in have]
    flags = [
        f"int({f}_available) AS {f}_available" if f"{f}_available" in have
        else f"{1 if names else 0} AS {f}_available"
        for f, names in found.items()
    ]
    window_id = "window_id" if "window_id" in have else "seq"
    clean = df.selectExpr(
        *ids, f"{window_id} AS window_id", *carried, *flags,
        *[f"{finite_sql(c)} AS `{c}`" for names in found.values() for c in names],
    )

    # counts, sums and extremes first: the later stages refer to them by name
    firsts = []
    for family, names in found.items():
        if not names:
            continue
        firsts += [
            f"{rs.row_count(names)} AS {family}__n",
            f"{rs.row_sum(names)} AS {family}__sum",
            f"{rs.row_max(names)} AS {family}__max",
        ]
        if family in ("latency", "start"):
            firsts.append(f"{rs.row_min(names)} AS {family}__min")
        if family == "latency":
            firsts.append(f"{rs.row_sorted(names)} AS latency__sorted")
    one = clean.selectExpr("*", *firsts)
    means = [f"{rs.row_mean(f'{f}__sum', f'{f}__n')} AS {f}__mean" for f, names in found.items() if names]
    two = one.selectExpr("*", *means)

    values: dict[str, str] = {}
    for family, names in found.items():
        n, mean = f"{family}__n", f"{family}__mean"
        out = {"max": f"{family}__max", "min": f"{family}__min", "mean": mean}
        out["std"] = rs.row_std(names, mean, n) if names else ""
        if family == "latency":
            for name, p in QUANTILES.items():
                values[name] = rs.row_quantile("latency__sorted", n, len(names), p)
            values |= {f"{stat}_latency": out[stat] for stat in ("mean", "max", "min", "std")}
            values["latency_service_count"] = n
        elif family == "start":
            values |= {f"{stat}_start": out[stat] for stat in ("mean", "max", "min", "std")}
            values["span_start"] = "start__max - start__min"
        else:
            values |= {f"{family}_{stat}": out[stat] for stat in ("max", "mean", "std")}
            values |= {f"{family}_total": f"{family}__sum", f"{family}_service_count": n}
    available = [f"{f}_available" for f in found]
    three = two.selectExpr(
        *ids, "window_id", *carried, *available,
        *[
            f"{_guarded(name, value, bool(found[families_of(name)[0]]))} AS {name}"
            for name, value in values.items()
        ],
    )
    return with_ratios(three)


def _guarded(name: str, value: str, has_columns: bool) -> str:
    kind = "INT" if name.endswith("_count") else "DOUBLE"
    return when_present(families_of(name), value) if has_columns else f"CAST(NULL AS {kind})"


def with_ratios(state: DataFrame) -> DataFrame:
    """Latency-to-resource ratios and the two mixed sums."""
    ratios = [
        f"{when_present(('latency', f), safe_ratio_sql('p95_latency', f'{f}_total'))} AS latency_to_{f}_ratio"
        for f in RESOURCE_FAMILIES
    ]
    sums = [
        f"{when_present(pair, f'coalesce({pair[0]}_total, 0D) + coalesce({pair[1]}_total, 0D)')} AS {name}"
        for name, pair in SUM_COLUMNS.items()
    ]
    return state.selectExpr("*", *ratios, *sums)


def state_from_long(
    long: DataFrame, keys: list[str], available: DataFrame | None = None, layout: Layout | None = None
) -> DataFrame:
    """The same state from ``(keys, family, value)`` rows: one grouped pass.

    For sources that arrive in long form. A family without any value in a
    sample counts as absent unless ``available`` (sample_key, flags) says so.
    With a split ``layout`` of the keys, windows may have any number of rows.
    """
    def of(family: str) -> Column:
        return F.when(F.col("family") == family, F.col("value"))

    split = layout is not None and layout.split
    aggs = [] if split else [F.percentile(of("latency"), F.lit(p)).alias(n) for n, p in QUANTILES.items()]
    aggs += [
        F.avg(of("latency")).alias("mean_latency"), F.max(of("latency")).alias("max_latency"),
        F.min(of("latency")).alias("min_latency"),
        zero_if_null(F.stddev_samp(of("latency"))).alias("std_latency"),
        F.count(of("latency")).cast("int").alias("latency_service_count"),
        F.avg(of("start")).alias("mean_start"), F.max(of("start")).alias("max_start"),
        F.min(of("start")).alias("min_start"), zero_if_null(F.stddev_samp(of("start"))).alias("std_start"),
        (F.max(of("start")) - F.min(of("start"))).alias("span_start"),
    ]
    for family in RESOURCE_FAMILIES:
        aggs += [
            zero_if_null(F.sum(of(family))).alias(f"{family}_total"),
            F.max(of(family)).alias(f"{family}_max"),
            F.avg(of(family)).alias(f"{family}_mean"),
            zero_if_null(F.stddev_samp(of(family))).alias(f"{family}_std"),
            F.count(of(family)).cast("int").alias(f"{family}_service_count"),
        ]
    grouped = long.groupBy(*keys).agg(*aggs)
    if split:
        latency = long.where("family = 'latency'")
        found = exact_quantiles(latency, layout.by(*keys), {n: ("value", p) for n, p in QUANTILES.items()})
        grouped = join_on(grouped, found, keys, "left")
    if available is None:
        available = long.groupBy(keys[0]).agg(*[
            F.coalesce(F.max(F.when(of(f).isNotNull(), 1)), F.lit(0)).alias(f"{f}_available")
            for f in ("latency", "start", *RESOURCE_FAMILIES)
        ])
    joined = join_on(grouped, available, keys[:1])
    own = [c for c in (*LATENCY_COLUMNS, *START_COLUMNS)]
    own += [f"{f}_{s}" for f in RESOURCE_FAMILIES for s in RESOURCE_STATS]
    rest = [c for c in joined.columns if c not in own]
    return with_ratios(joined.selectExpr(*rest, *[f"{when_present(families_of(c), c)} AS {c}" for c in own]))


def fill_state(df: DataFrame, dynamics: dict[str, str] | None = None) -> DataFrame:
    """Missing numbers of present families become 0; absent families stay NULL.

    ``dynamics`` maps each dynamic column to the state column it comes from.
    The helper flags of latency and start, which are no state columns, go.
    """
    source = {c: c for c in state_columns() if not c.endswith("_available")} | (dynamics or {})
    out = []
    for field in df.schema.fields:
        name, numeric = field.name, isinstance(field.dataType, T.NumericType)
        if name in source:
            out.append(f"{when_present(families_of(source[name]), f'coalesce({name}, 0)')} AS {name}")
        elif name in ("window_id", *PASSTHROUGH) and numeric:
            out.append(f"coalesce({name}, 0) AS {name}")
        elif name not in ("latency_available", "start_available"):
            out.append(f"`{name}`")
    return df.selectExpr(*out)
