"""Service graph: degrees, placement, risk and latency of services."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.functions.scalars import zero_if_null
from perfwatch.operators.reports import filter_scenario

# Fixed values of the risk score.
RISK_BASE, RISK_IN, RISK_OUT, RISK_SHARE, RISK_CAP = 18.0, 6.0, 4.0, 0.35, 100.0
P95_BASE, P95_PER_RISK = 95_000.0, 4_200.0
LAST_ROWS = 20


def degrees(edges: DataFrame) -> DataFrame:
    """Calls out and in per service; a self-loop counts in both.

    Each edge gives two rows, so both degrees come from one pre-aggregated pass.
    """
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("source_service").alias("service"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("target_service").alias("service"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )))
    return ends.groupBy("service").agg(F.sum("o").alias("rpc_out"), F.sum("i").alias("rpc_in"))


def services_of(edges: DataFrame, telemetry: DataFrame, scenario: str = "all") -> DataFrame:
    """Distinct services of telemetry and graph; ``system`` if there is none."""
    edges, telemetry = filter_scenario(edges, scenario), filter_scenario(telemetry, scenario)
    found = (
        telemetry.select("service")
        .union(edges.select(F.inline(F.array(
            F.struct(F.col("source_service").alias("service")), F.struct(F.col("target_service").alias("service")),
        ))))
        .where("service is not null")
        .distinct()
    )
    default = found.agg(F.count(F.lit(1)).alias("c")).where("c = 0").select(F.lit("system").alias("service"))
    return found.union(default)


def with_placement(services: DataFrame, placement: DataFrame) -> DataFrame:
    """Left join of the node of each service; ``-`` if it has none."""
    nodes = placement.groupBy("service").agg(F.min("node").alias("node"))
    return services.join(nodes, "service", "left").withColumn("node", F.coalesce("node", F.lit("-")))


def telemetry_by_service(telemetry: DataFrame, order: list[str]) -> DataFrame:
    """Risk share and the mean p95 of the last rows of each service.

    The rank filter is pushed below the shuffle (at most 20 rows per service
    and task travel), so a service with most of the rows is no hot task.
    """
    share = telemetry.groupBy("service").agg((F.avg("system_anomaly") * 100).alias("risk_share"))
    return share.join(last_mean(telemetry, ["service"], order, "p95_latency", LAST_ROWS), "service", "left")


def last_mean(df: DataFrame, keys: list[str], order: list[str], value: str, rows: int = LAST_ROWS) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    ranked = df.select(*keys, *[c for c in order if c not in keys], value).withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= rows).groupBy(*keys).agg(F.avg(value).alias(f"recent_{value}"))


def service_summary(
    telemetry: DataFrame, edges: DataFrame, placement: DataFrame, scenario: str = "all",
    order: tuple[str, ...] = ("step", "scenario"), rounded: bool = True,
) -> DataFrame:
    """Node, degrees, risk score and recent p95 of every service in the graph."""
    graph = degrees(filter_scenario(edges, scenario))
    recent = telemetry_by_service(filter_scenario(telemetry, scenario), list(order))
    joined = with_placement(graph, placement).join(recent, "service", "left")
    risk = F.greatest(F.lit(0.0), F.least(
        F.lit(RISK_CAP),
        F.lit(RISK_BASE) + RISK_IN * F.col("rpc_in") + RISK_OUT * F.col("rpc_out")
        + RISK_SHARE * zero_if_null(F.col("risk_share")),
    ))
    p95 = F.coalesce(F.col("recent_p95_latency"), F.lit(P95_BASE) + P95_PER_RISK * F.col("risk_score"))
    out = joined.withColumn("risk_score", risk).withColumn("p95_latency", p95)
    if rounded:
        out = out.withColumns({"risk_score": F.round("risk_score", 1), "p95_latency": F.round("p95_latency", 0)})
    return out.select("service", "node", "rpc_in", "rpc_out", "risk_score", "p95_latency").orderBy(
        F.desc("risk_score"), "service"
    )


def top_risk(summary: DataFrame, top: int = 12) -> DataFrame:
    return summary.orderBy(F.desc("risk_score"), "service").limit(top)
