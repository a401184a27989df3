"""File discovery and scans of telemetry and result trees."""

from __future__ import annotations

import csv
import io
import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.operators.families import family_columns, gate_resources, lineage
from perfwatch.operators.ordering import Layout, fits_task, measure, positions
from perfwatch.operators.validation import MANIFEST_COLUMNS, require_columns, require_rows
from perfwatch.session import stage
from perfwatch.sources.tables import unite

# Cell texts that count as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TABLE_READERS = {".csv": "csv", ".parquet": "parquet"}
#: Bytes of a Parquet footer that Spark's reader accepts at most; a file without rows has little else.
FOOTER_BYTES = 100 << 20


def path_order(path: Column) -> Column:
    """Component-wise path order."""
    return F.split(path, "/")


def discover(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """Paths and sizes of the files under ``root``; contents are not read.

    Spark's file index leaves out files of zero bytes.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
    )
    return files.select("path", "length")


def batch_slice(files: DataFrame, start: int = 0, size: int | None = None) -> DataFrame:
    """Files ``start .. start + size - 1`` in path order, with the name of their part."""
    ordered = positions(
        files.withColumn("_order", path_order(F.col("path"))), measure(files, []), ["_order"], "file_index", "_total"
    ).drop("_order")
    end = F.col("_total") if size is None else F.least(F.col("_total"), F.lit(start + size))
    name = F.format_string("part_%04d_%04d", F.lit(start), end - 1)
    return ordered.where((F.col("file_index") >= start) & (F.col("file_index") < end)).select(
        "path", "file_index", name.alias("part_name")
    )


def csv_lines(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """(path, block, line, value) of the non-blank records of the CSV files under ``root``, stored.

    Text is read once, by Spark's own reader, so any store that Spark reads
    will do. ``files`` (path) restricts the files. (block, line) is the order
    of the records in a file however it is split. A quoted line break is part
    of its record.
    """
    text = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").option("ignoreCorruptFiles", "true")
        .text(root)
    )
    lines = text.select(
        plain_path(stored_path()).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    if files is not None:
        lines = lines.join(files.select(plain_path(F.col("path")).alias("path")), "path", "left_semi")
    return csv_records(stage(lines, "lines")).where(F.trim("value") != "")


def csv_records(lines: DataFrame) -> DataFrame:
    """Lines (path, block, line, value; stored) with those of a quoted line break joined to one record.

    A line with an odd number of quotes opens or closes a quoted stretch. The
    number of such lines before a line is the sum over the blocks before its
    own, one row each, and a running count within its block, so a file of any
    length is scanned block by block. A quote that never closes opens nothing.
    Files without such lines pass as they are.
    """
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2
    blocks = lines.where(odd == 1).groupBy("path", "block").agg(F.count(F.lit(1)).alias("odd"))
    if blocks.isEmpty():
        return lines
    of_file = Window.partitionBy("path")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.select("path", "block").distinct().join(blocks, ["path", "block"], "left").fillna(0, ["odd"]).select(
        "path", "block", F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"), F.sum("odd").over(of_file).alias("total"),
    ).where("total > 1")
    whole = lines.join(blocks.select("path").distinct(), "path", "left_anti")
    in_block = Window.partitionBy("path", "block").orderBy("line")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("odd", odd).join(blocks, ["path", "block"]).withColumn(
        "count", F.col("before") + F.sum("odd").over(upto)
    )
    closing = F.col("total") - F.col("total") % 2  # a last odd line without a partner does not count
    before, after = (F.least(n, closing) for n in (F.col("count") - F.col("odd"), F.col("count")))
    starts = counted.select("path", "block", "line", "value", (before % 2 == 0).alias("starts"), (after % 2 == 1).alias("goes_on"))
    # The place of the record a line belongs to: its own block's last start, else that of the blocks before.
    place = F.when(F.col("starts"), F.struct("block", "line"))
    own = starts.withColumn("own", F.last(place, True).over(upto))
    last = own.groupBy("path", "block").agg(F.max("own").alias("last"))
    carried = last.withColumn("carried", F.last("last", True).over(earlier)).select("path", "block", "carried")
    placed = stage(own.join(carried, ["path", "block"]).withColumn("at", F.coalesce("own", "carried")), "records")
    alone = placed.where("starts AND NOT goes_on").select(lines.columns)
    parts = placed.where("NOT starts OR goes_on").groupBy("path", "at").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts")
    )
    joined = parts.select("path", "at.block", "at.line", F.array_join("parts.value", "\n").alias("value"))
    return stage(whole.unionByName(alone).unionByName(joined.select(lines.columns)), "lines")


def csv_headers(lines: DataFrame) -> DataFrame:
    """(path, header, first): the whole first line of each file and its place. A blank file has none."""
    starts = lines.where("block = 0").groupBy("path").agg(F.min("line").alias("line"))
    header = F.regexp_replace("value", "^\ufeff", "")
    return lines.join(starts, ["path", "line"]).select("path", header.alias("header"), F.col("line").alias("first"))


def _without_missing(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])


def parse_csv(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """The rows of all files as text under the names of their own header, with ``<family>_available`` flags.

    Files of different headers are parsed in one scan: a name takes the cell
    at the place it has in the header of the row's file. Only distinct headers
    reach the driver. Adds _path, _block and _line.
    """
    spark = lines.sparkSession
    known = sorted(r[0] for r in headers.select("header").distinct().collect())
    names = [next(csv.reader(io.StringIO(h))) for h in known]
    width = max((len(n) for n in names), default=0)
    if not width:
        raise FileNotFoundError("No readable CSV file")
    places: dict[str, dict[int, int]] = {}
    for i, columns in enumerate(names):
        for j, name in enumerate(columns):
            places.setdefault(name, {}).setdefault(i, j)
    own = F.array_position(F.array(*map(F.lit, known)), F.col("header")) - 1
    kinds = headers.select("path", "first", own.cast("int").alias("_kind"))
    rows = lines.join(kinds, "path").where(F.col("line") != F.col("first"))
    cells = rows.select(
        F.from_csv("value", ", ".join(f"c{j} string" for j in range(width)), {"escape": '"'}).alias("_cells"), "_kind",
        F.col("path").alias("_path"), F.col("block").alias("_block"), F.col("line").alias("_line"),
    )

    def cell(at: dict[int, int]) -> Column:
        if len(at) == len(known) and len(set(at.values())) == 1:
            return F.col(f"_cells.c{next(iter(at.values()))}")
        by_place: dict[int, list[int]] = {}
        for kind, place in at.items():
            by_place.setdefault(place, []).append(kind)
        return F.coalesce(*[F.when(F.col("_kind").isin(k), F.col(f"_cells.c{j}")) for j, k in by_place.items()])

    has: dict[str, list[int]] = {}
    for i, columns in enumerate(names):
        empty = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(columns)]))
        for family, found in family_columns(empty, numeric_only=False).items():
            has.setdefault(f"{family}_available", []).extend([i] if found else [])
    flags = [F.when(F.col("_kind").isin(k), 1).otherwise(0).alias(f) for f, k in has.items() if f not in places]
    return _without_missing(cells.select(*[cell(at).alias(n) for n, at in places.items()], *flags, "_path", "_block", "_line"))


def read_telemetry_csv(
    spark: SparkSession, root: str, files: DataFrame | None = None, lines: DataFrame | None = None
) -> tuple[DataFrame, Layout]:
    """Wide telemetry of a CSV tree: one sample per file, with ``seq`` in file order.

    ``label_trace`` is a whole number if all of its values are numbers, else it stays text.
    """
    files = discover(spark, root) if files is None else files
    lines = csv_lines(spark, root, files) if lines is None else lines
    headers = csv_headers(lines)
    wide = parse_csv(lines, headers)
    relative = below_root(F.col("_path"), root)
    named = wide.withColumns({
        **lineage(relative),
        "sample_key": F.regexp_replace(relative, r"\.[^./]*$", ""),
    })
    gated = gate_resources(named, "sample_key")
    typed = {}
    if "window_id" in gated.columns:
        typed["window_id"] = F.col("window_id").try_cast("double").cast("bigint")
    if "label_trace" in gated.columns:
        number = F.col("label_trace").try_cast("double")
        if named.where(F.col("label_trace").isNotNull() & number.isNull()).isEmpty():
            typed["label_trace"] = number.cast("bigint")
    gated = gated.withColumns(typed) if typed else gated
    layout = _file_layout(files, named)
    return positions(gated, layout, ["_block", "_line"], "seq", "n").drop("_path", "_block", "_line"), layout


def _file_layout(files: DataFrame, rows: DataFrame) -> Layout:
    """Row count of the longest file: bounded by its bytes (a row has two at least), else counted."""
    if "length" in files.columns:
        if fits_task((files.agg(F.max("length")).first()[0] or 0) // 2):
            return Layout(("sample_key",))
    return measure(rows, ["sample_key"])


def _regex_quote(text: str) -> str:
    return r"\Q" + text + r"\E"


def read_parquet(spark: SparkSession, *paths: str, tolerant: bool = False) -> DataFrame:
    """Parquet scan over one or many paths, merged by name."""
    return (
        spark.read.option("mergeSchema", "true")
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .parquet(*paths)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV or Parquet by suffix."""
    suffix = "." + path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in TABLE_READERS:
        raise ValueError(f"Unsupported table format {suffix}; supported: {sorted(TABLE_READERS)}")
    if suffix == ".csv":
        reader = spark.read.option("header", "true")
        return reader.schema(schema).csv(path) if schema else reader.csv(path)
    return spark.read.parquet(path)


def read_json(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Multi-line JSON documents with nested objects flattened to dotted names."""
    reader = spark.read.option("multiLine", "true")
    return flatten_structs((reader.schema(schema) if schema else reader).json(list(paths)))


def flatten_structs(df: DataFrame) -> DataFrame:
    def leaves(schema: T.StructType, path: list[str]):
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here))

    return df.select(*leaves(df.schema, []))


def read_tolerant(spark: SparkSession, listing: DataFrame, root: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of the readable Parquet files under ``root``, and the files that cannot be read.

    The schema is passed in, so a damaged footer cannot stop the scan. A table
    without rows is readable.
    """
    rows = (
        spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").parquet(root)
        .withColumn("dataset_source_path", stored_path())
    )
    seen = rows.select(plain_path(F.col("dataset_source_path")).alias("_seen")).distinct()
    silent = listing.join(seen, plain_path(F.col("path")) == F.col("_seen"), "left_anti")
    return rows, unreadable(silent)


def _tables_without_rows(batches):
    """``path`` of those whose ``content`` is a Parquet table that holds no rows."""
    for batch in batches:
        empty = []
        for content in batch.column("content"):
            try:
                empty.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows == 0)
            except (pa.ArrowException, OSError):
                empty.append(False)
        yield batch.filter(pa.array(empty, pa.bool_())).select(["path"])


def unreadable(silent: DataFrame) -> DataFrame:
    """``silent`` (path, ...; files that gave no rows) without the Parquet tables that hold none.

    Writers leave such tables, Spark's first task for one. Only the paths of
    silent files reach the driver, which lists them for Spark's scan.
    """
    silent = stage(silent, "silent")
    paths = [r[0] for r in silent.where("path like '%.parquet'").select("path").collect()]
    if not paths:
        return silent
    # names are taken as they are, not as patterns
    found = silent.sparkSession.read.format("binaryFile").load([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths])
    whole = found.where((F.col("length") <= FOOTER_BYTES) & (F.substring("content", -4, 4) == F.lit(b"PAR1")))
    empty = whole.select("path", "content").mapInArrow(_tables_without_rows, "path string").select(plain_path(F.col("path")).alias("_empty"))
    return silent.join(empty, plain_path(F.col("path")) == F.col("_empty"), "left_anti")


def plain_path(path: Column) -> Column:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, "^file:/+", "/")


def stored_path() -> Column:
    """The path a row was read from, as a listing spells it: metadata paths are percent-encoded."""
    encoded = F.regexp_replace("_metadata.file_path", r"\+", "%2B")
    return F.coalesce(F.try_url_decode(encoded), F.col("_metadata.file_path"))


def below_root(path: Column, root: str) -> Column:
    """``path`` without the whole of ``root``; a root without a scheme is a local folder."""
    plain = re.sub("^file:/+", "/", root)
    plain = (plain if "://" in plain else os.path.abspath(plain)).rstrip("/") + "/"
    return F.regexp_replace(plain_path(path), "^" + _regex_quote(plain), "")


def select_role(manifest: DataFrame, role: str, scenario: str | None = None) -> DataFrame:
    """Manifest rows of a role and scenario, one suffix per sample.

    A sample saved both as Parquet and CSV is read once, from Parquet.
    """
    require_columns(manifest, MANIFEST_COLUMNS, "Manifest index")
    chosen = manifest.where(F.col("file_role") == role)
    if scenario and scenario != "all":
        chosen = chosen.where(F.col("relative_path_from_part").rlike(f"(^|/)(scenario=)?{_regex_quote(scenario)}/"))
    if {"logical_sample_key", "file_suffix", "predictive_root"} <= set(manifest.columns):
        keys = ["predictive_root", "logical_sample_key"]
        best = chosen.groupBy(*keys).agg(F.max("file_suffix").alias("_best"))
        chosen = chosen.join(best, keys).where(F.col("file_suffix") == F.col("_best")).select(*manifest.columns)
    return chosen


def read_role(
    spark: SparkSession, manifest: DataFrame, role: str, scenario: str | None = None, tolerant: bool = True, ordered: bool = False
) -> DataFrame:
    """One scan over the files of a role; only their paths reach the driver, which lists them for Spark anyway.

    ``ordered`` adds the stored order of the rows: ``_source`` (a file, or a
    directory of part files), ``_file``, ``_block`` and ``_row``.
    """
    paths = [r[0] for r in select_role(manifest, role, scenario).select("absolute_path").collect()]
    if not paths:
        raise FileNotFoundError(f"No readable files for role={role}, scenario={scenario}")
    parquet = [p for p in paths if not p.lower().endswith(".csv")]
    frames = {}
    if parquet:
        frames["parquet"] = read_parquet(spark, *parquet, tolerant=tolerant)
    if len(parquet) < len(paths):
        texts = [p for p in paths if p.lower().endswith(".csv")]
        frames["csv"] = spark.read.option("header", "true").option("inferSchema", "true").csv(texts)
    named = {k: df.withColumn("dataset_source_path", stored_path()) for k, df in frames.items()}
    if ordered:
        row = {"parquet": F.col("_metadata.row_index"), "csv": F.monotonically_increasing_id()}
        named = {k: df.withColumns({
            "_file": plain_path(F.col("dataset_source_path")), "_block": F.col("_metadata.file_block_start"), "_row": row[k],
            "_source": F.regexp_replace(plain_path(F.col("dataset_source_path")), r"/part-[^/]*$", ""),
        }) for k, df in named.items()}
    return require_rows(unite(named, "_format").drop("_format"), f"{role} dataset")


# --- result trees ----------------------------------------------------------

_TREE = r"/([^/]+)/([^/]+?)(?:\.(?:parquet|csv|json))?(?:/[^/]*)?$"


def path_parts(path: Column, pattern: str = _TREE) -> dict[str, Column]:
    """Scenario (parent directory) and model (stem) of a result path."""
    return {
        "scenario": F.regexp_extract(path, pattern, 1),
        "model": F.regexp_replace(F.regexp_extract(path, pattern, 2), "_test_predictions$", ""),
    }


#: A prediction table, as a file or a directory of part files; directories may be spelled ``name=value``.
_PREDICTIONS = r"^(.*?)(?:([^/]+)/)?([^/]+)/([^/]+)_test_predictions\.(parquet|csv)(?:/[^/]*)?$"
PREDICTION_SCHEMA = "split string, y_true double, y_pred double, anomaly_probability double"


def prediction_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, prediction_file, task, scenario, model, kind) of every prediction file under ``root``, at any depth.

    Scenario is the parent directory of a table and task that of the scenario
    (below ``root``). ``prediction_file`` is the table below ``root``.
    """
    found = discover(spark, root, "").select("path", below_root(F.col("path"), root).alias("_below"))

    def piece(i: int) -> Column:
        return F.regexp_replace(F.regexp_extract(F.concat(F.lit("./"), "_below"), _PREDICTIONS, i), "^[^=/]*=", "")

    named = found.where(F.concat(F.lit("./"), "_below").rlike(_PREDICTIONS)).select(
        "path", F.regexp_replace("_below", r"(_test_predictions\.(?:parquet|csv))/[^/]*$", "$1").alias("prediction_file"),
        F.nullif(F.nullif(piece(2), F.lit("")), F.lit(".")).alias("task"), F.nullif(piece(3), F.lit(".")).alias("scenario"),
        piece(4).alias("model"), piece(5).alias("kind"),
    )
    return named.withColumn("path", plain_path(F.col("path")))


def load_prediction_tree(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All predictions under ``root``, and the files (path) that are skipped.

    Parquet and CSV tables may be mixed, in any depth and with columns in any
    order; a column that a table lacks is NULL. Files that cannot be read, and
    CSV files without ``y_true`` and ``y_pred``, are skipped; tables without
    rows are not. ``step`` counts the rows of a table in stored order.
    """
    known = stage(prediction_files(spark, root), "listing")
    schema = T.StructType.fromDDL(PREDICTION_SCHEMA)
    parquet = (
        spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").parquet(root)
        .select("*", plain_path(stored_path()).alias("path"), F.lit(0).cast("bigint").alias("_block"), F.col("_metadata.row_index").alias("_row"))
    )
    rows, read = parquet, []
    texts = known.where("kind = 'csv'").select("path")
    lines = csv_lines(spark, root, texts)
    headers = csv_headers(lines)
    if not headers.isEmpty():
        cells = parse_csv(lines, headers)
        csv_rows = cells.select(
            *[(F.col(f.name) if f.name in cells.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema.fields],
            F.col("_path").alias("path"), F.col("_block").alias("_block"), F.col("_line").alias("_row"),
        )
        named = headers.where(F.forall(F.array(F.lit("y_true"), F.lit("y_pred")), lambda c: F.array_contains(F.split("header", '"?,"?'), c)))
        rows, read = rows.unionByName(csv_rows.join(named.select("path"), "path", "left_semi")), [named.select("path")]
    rows = stage(rows.join(known, "path"), "predictions")
    silent = known.select("path")
    for files in (rows.select("path").distinct(), *read):
        silent = silent.join(files, "path", "left_anti")
    skipped = unreadable(silent)
    placed = positions(rows, measure(rows, ["prediction_file"]), ["path", "_block", "_row"], "step")
    return placed.select("task", "scenario", "model", "prediction_file", "step", *schema.names), skipped


def load_predictions(spark: SparkSession, root: str) -> DataFrame:
    """All test predictions ``<model>_test_predictions.parquet`` or ``.csv`` under ``root``, with scenario, model and step."""
    return load_prediction_tree(spark, root)[0]


def load_metrics(spark: SparkSession, root: str, task: str, schema: str) -> DataFrame:
    """Metric tables ``<scenario>/<task>_metrics.csv`` under ``root``."""
    rows = spark.read.option("header", "true").schema(schema).csv(f"{root}/*/{task}_metrics.csv")
    return rows.withColumn("scenario", F.regexp_extract(stored_path(), rf"/([^/]+)/{task}_metrics\.csv", 1))


def panel_telemetry(marked: DataFrame, order: list[str]) -> DataFrame:
    """Marked state as panel telemetry: scenario, running step, default service."""
    out = marked
    if "source_level_1" in out.columns:
        out = out.withColumn("scenario", F.col("source_level_1"))
    elif "scenario" not in out.columns:
        out = out.withColumn("scenario", F.lit("all"))
    if "service" not in out.columns:
        out = out.withColumn("service", F.lit("system"))
    if "step" not in out.columns:
        out = positions(out, measure(out, []), order, "step")
    return out


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small CSV dimension (service graph, placement) with a fixed schema."""
    return spark.read.option("header", "true").schema(schema).csv(path)


RPC_SCHEMA = "scenario string, source_operation string, source_service string, target_service string"
PLACEMENT_SCHEMA = "service string, node string"
