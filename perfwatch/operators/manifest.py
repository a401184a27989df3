"""Logical manifest: index of processed files, samples and roles from path texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Role by file stem, and the suffixes that are indexed.
ROLE_BY_STEM = {
    "aggregated_system_state": "aggregated",
    "marked_anomaly_state": "marked",
    "predictive_p95_dataset": "predictive",
    "train": "train",
    "val": "val",
    "test": "test",
    "metadata": "metadata",
}
SUFFIXES = [".parquet", ".csv", ".json"]
ROOT_NAME = "predictive_processed_dataset"
COMMITS_NAME = "predictive_processed_commits"
VERSION = r"\.v(\d{20}-[0-9a-f]{8})"
ORDER = ["part_name", "scenario", "logical_sample_key", "file_role"]


def dataset_roots(paths: DataFrame) -> DataFrame:
    """Distinct dataset roots among file paths, sorted."""
    found = paths.select(F.split("path", f"/{ROOT_NAME}/", 2).alias("pieces")).where("size(pieces) = 2")
    return found.selectExpr(f"concat(pieces[0], '/{ROOT_NAME}') AS predictive_root").distinct().orderBy("predictive_root")


def valid_paths(paths: DataFrame) -> DataFrame:
    """(path) of the files that no later run has replaced.

    The listing holds commit records (``<commits>/logical_sample_key=s/version=v/..``).
    A file of a versioned part is valid if its version is the last one recorded for its sample;
    files of other parts always are.
    """
    found = paths.select(
        "path",
        F.regexp_extract("path", f"^(.*)/(?:{ROOT_NAME}|{COMMITS_NAME})/", 1).alias("base"),
        F.regexp_extract("path", r"/logical_sample_key=([^/]+)/", 1).alias("sample"),
        F.regexp_extract("path", rf"/{ROOT_NAME}/[^/]*?{VERSION}/", 1).alias("own"),
        F.regexp_extract("path", rf"/{COMMITS_NAME}/logical_sample_key=[^/]+/version=([^/]+)/", 1).alias("recorded"),
    )
    plain = (F.col("own") == "") & (F.col("recorded") == "")
    group = F.when(plain, F.col("path")).otherwise(F.concat_ws("/", "base", "sample"))
    last = F.max("recorded").over(Window.partitionBy(group))
    return found.withColumn("last", last).where((F.col("recorded") == "") & ((F.col("own") == "") | (F.col("own") == F.col("last")))).select("path")


def files_index(paths: DataFrame) -> DataFrame:
    """One row per processed file with its role, part, scenario and sample.

    The role is the file stem or, for partitioned writes, the ``file_role=``
    directory. Files without a role are left out, and files that a later run
    of their sample has replaced (see ``valid_paths``).
    """
    pieces = valid_paths(paths).select("path", F.split("path", f"/{ROOT_NAME}/", 2).alias("pieces")).where("size(pieces) = 2")
    named = pieces.selectExpr(
        "path AS absolute_path",
        "pieces[1] AS relative_path_from_part",
        f"concat(pieces[0], '/{ROOT_NAME}') AS predictive_root",
        "substring_index(pieces[1], '/', -1) AS file_name",
        "split(pieces[1], '/') AS parts",
    )
    roles = F.create_map(*[F.lit(x) for pair in ROLE_BY_STEM.items() for x in pair])
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    written = F.when(F.contains("relative_path_from_part", F.lit("file_role=")), F.nullif(
        F.regexp_extract("relative_path_from_part", r"(?:^|/)file_role=([^/]+)/", 1), F.lit("")
    ))
    # ``part_name=x`` directories of partitioned writes count as ``x``
    plain = r"^(part_name|scenario)="
    return named.select(
        "absolute_path",
        F.coalesce(written, F.try_element_at(roles, stem)).alias("file_role"),
        "relative_path_from_part",
        "predictive_root",
        F.regexp_replace(F.regexp_replace(F.get("parts", F.lit(0)), plain, ""), VERSION + "$", "").alias("part_name"),
        F.coalesce(F.regexp_replace(F.get("parts", F.lit(1)), plain, ""), F.lit("")).alias("scenario"),
        F.when(F.size("parts") > 1, F.regexp_replace(
            F.regexp_replace("relative_path_from_part", r"(/file_role=[^/]*)?/[^/]*$", ""), rf"^([^/]*?){VERSION}(/|$)", "$1$3"
        ))
        .otherwise(stem).alias("logical_sample_key"),
        "file_name",
        F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1)).alias("file_suffix"),
        F.when(F.size("parts") > 1, F.get("parts", F.size("parts") - 2)).otherwise(F.lit(ROOT_NAME)).alias("parent_dir_name"),
    ).where(F.col("file_role").isNotNull() & F.col("file_suffix").isin(SUFFIXES))


def sorted_index(index: DataFrame) -> DataFrame:
    return index.orderBy(*ORDER, "absolute_path")


def samples_index(index: DataFrame) -> DataFrame:
    """One row per sample of a root: file count and the roles it has."""
    def has(role: str) -> Column:
        return F.bool_or(F.col("file_role") == role)

    return index.groupBy("predictive_root", "logical_sample_key").agg(
        F.min("part_name").alias("part_name"),
        F.min("scenario").alias("scenario"),
        F.count(F.lit(1)).alias("file_count"),
        *[has(role).alias(f"has_{role}") for role in ("predictive", "train", "val", "test", "metadata")],
        (has("train") & has("val") & has("test")).alias("is_complete_for_training"),
    )


def role_index(index: DataFrame) -> DataFrame:
    return index.groupBy("file_role", "file_suffix").agg(F.count(F.lit(1)).alias("file_count"))


def manifest_summary(index: DataFrame) -> DataFrame:
    """One row: counts, roles and scenarios of the manifest."""
    samples = samples_index(index)
    roles = role_index(index)
    return samples.agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count_if("is_complete_for_training").alias("complete_training_sample_count"),
        F.coalesce(F.sum("file_count"), F.lit(0)).alias("file_count"),
        F.sort_array(F.collect_set("scenario")).alias("scenarios"),
    ).withColumn(
        "roles",
        roles.agg(F.sort_array(F.collect_list(F.struct("file_role", "file_suffix", "file_count")))).scalar(),
    )
