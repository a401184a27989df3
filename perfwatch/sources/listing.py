"""A listing of every file of a tree, also of those that Spark's file index leaves out."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from perfwatch.sources.files import discover, plain_path

EMPTY, HIDDEN = "empty file", "hidden name"


def _reached(root: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of ``root``, its path there, and what Spark puts before such a path."""
    local = re.sub("^file:/+", "/", root)
    if "://" not in local:
        return fs.LocalFileSystem(), os.path.abspath(local), "file:"
    store, path = fs.FileSystem.from_uri(root)
    path = path.rstrip("/")
    return store, path, root.rstrip("/").removesuffix(path)


@dataclass
class Directory(InputPartition):
    path: str
    recursive: bool


class TreeReader(DataSourceReader):
    def __init__(self, root: str, suffix: str):
        self.root, self.suffix = root, suffix

    def partitions(self) -> list[Directory]:
        """The files of the root, and one partition for each directory below it."""
        store, base, _ = _reached(self.root)
        below = [x.path for x in store.get_file_info(fs.FileSelector(base)) if x.type == fs.FileType.Directory]
        return [Directory(base, False), *(Directory(p, True) for p in below)]

    def read(self, partition: Directory):
        store, _, prefix = _reached(self.root)
        for x in store.get_file_info(fs.FileSelector(partition.path, allow_not_found=True, recursive=partition.recursive)):
            if x.type == fs.FileType.File and x.base_name.endswith(self.suffix):
                yield prefix + x.path, x.size


class TreeListing(DataSource):
    """``path`` and ``length`` of the files under the loaded path whose name ends with the option ``suffix``."""

    @classmethod
    def name(cls) -> str:
        return "every_file"

    def schema(self) -> str:
        return "path string, length bigint"

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options["path"], self.options.get("suffix", ""))


def every_file(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """(path, length, left_out) of every file under ``root``; contents are not read.

    ``left_out`` says why Spark's scans skip a file: it has no bytes, or its
    name or a directory's starts with ``_`` or ``.``; NULL for all others. The
    tree is listed by tasks, one for each directory of the root, through
    pyarrow's file systems.
    """
    spark.dataSource.register(TreeListing)
    listed = spark.read.format(TreeListing.name()).option("suffix", suffix).load(root)
    seen = discover(spark, root, suffix).select(F.col("path").alias("_seen"))
    reason = F.when(F.col("_seen").isNull(), F.when(F.col("length") == 0, EMPTY).otherwise(HIDDEN))
    return listed.join(seen, plain_path(F.col("path")) == plain_path(F.col("_seen")), "left").select(
        F.coalesce("_seen", "path").alias("path"), "length", reason.alias("left_out")
    )
