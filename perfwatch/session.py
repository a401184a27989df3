"""Session helpers: a tuned builder and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(app: str = "perfwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Shuffle parallelism is left to the cluster (AQE coalesces small
    partitions); only ``local`` runs get a small fixed number.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.maxFields", "400")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local run may leave it unset; it then gets a fresh temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_dirs[context.applicationId]


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and fixes values that
    depend on how rows were partitioned.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


STAGE_BYTES = 256 * 1024 * 1024


def reused(df: DataFrame, label: str, limit: int | None = None) -> DataFrame:
    """A frame that several passes read: stored if recomputing it would be costly.

    The planner's size estimate (file sizes, no job) decides; small inputs are
    cheaper to recompute than to write.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return stage(df, label) if estimate > (STAGE_BYTES if limit is None else limit) else df
