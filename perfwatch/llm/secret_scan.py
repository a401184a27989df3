"""Secret scans over a ledger of blobs.

Every version of every path is content-addressed by the SHA-256 of its text. A
ledger in a shared folder records the (blob, rule, rule version) triples that
have been scanned, and the findings. A scan hashes all versions, takes one
version of each distinct blob, and runs only the rules that the ledger does
not hold for it yet. Findings are joined back to all paths and versions that
carry the blob.

The ledger is append-only Parquet: findings are written before the entries
that mark a blob as scanned, so a run that dies in between is repeated and its
findings are counted once. Text is moved once, by version and not by blob, so
a blob with a third of all versions makes no large task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfwatch.session import stage, staging_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``hints``: the text must hold one of them (any case) for the pattern to be tried.

    A match counts if its group ``group`` has ``least`` characters or more;
    others are dropped after matching, so they still use up their text.
    """

    kind: str
    version: int
    pattern: str
    hints: tuple[str, ...] = ()
    group: int = 0
    least: int = 1

    def find(self, text: str, lower: str) -> Iterator[tuple[int, int]]:
        if self.hints and not any(h in lower for h in self.hints):
            return
        for m in re.finditer(self.pattern, text, re.ASCII):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.span()


#: Kinds in the order in which spans at one place are listed; the first three are the base.
RULES = (
    Rule(
        "assign", 1, r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+))""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"), 2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", (), 0, 24),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", ("private key-----",)),
    Rule("github", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
    Rule("url_password", 1, r"\b[a-z][a-z0-9+.-]{1,16}://[^\s/:@]{1,64}:[^\s/@]{1,128}@", ("://",)),
)
BASE = 3


def _read(spark, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


LEDGER = "blob string, kind string, version int"
FINDINGS = "blob string, kind string, version int, start int, end int"


def _scan(rules: tuple[Rule, ...]):
    by_kind = {r.kind: r for r in rules}

    def run(batches):
        for batch in batches:
            out = []
            for blob, text, kinds in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "kinds")), strict=True):
                lower = text.lower()
                out += [(blob, k, by_kind[k].version, *span) for k in kinds for span in by_kind[k].find(text, lower)]
            yield pa.RecordBatch.from_arrays([
                pa.array([o[i] for o in out], t)
                for i, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()))
            ], names=["blob", "kind", "version", "start", "end"])

    return run


def update(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger has not seen of ``versions`` (path, text) and return (path, blob) of all of them.

    Repeated (path, text) rows are one version. Null texts are empty texts.
    """
    spark = versions.sparkSession
    known = _read(spark, f"{ledger}/scanned", LEDGER)
    text = F.coalesce("text", F.lit(""))
    hashed = versions.select("path", F.sha2(text, 256).alias("blob"))
    placed = stage(hashed, "versions")
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    blobs = placed.groupBy("blob").agg(F.min("path").alias("path"))
    done = known.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("done"))
    todo = (
        blobs.join(done, "blob", "left")
        .withColumn("kinds", F.array_except(current, F.coalesce("done", F.array().cast("array<struct<kind:string,version:int>>"))))
        .filter(F.size("kinds") > 0).select("blob", "path", "kinds")
    )
    todo = stage(todo, "unseen")
    match = F.col("v.path").eqNullSafe(F.col("t.path")) & (F.sha2(F.col("v.text"), 256) == F.col("t.blob"))
    unseen = versions.select("path", text.alias("text")).alias("v").join(todo.alias("t"), match)
    found = unseen.select("t.blob", "v.text", F.col("t.kinds.kind").alias("kinds")).mapInArrow(_scan(rules), FINDINGS)
    found.write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", F.inline("kinds")).write.mode("append").parquet(f"{ledger}/scanned")
    return placed


def findings(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, start, end) by the current version of each rule; offsets are code points."""
    kept = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    rows = _read(spark, f"{ledger}/findings", FINDINGS)
    return rows.filter(F.array_contains(kept, F.struct("kind", "version"))).select("blob", "kind", "start", "end").distinct()


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Secrets of every document: n_assign, n_access, n_hex, base_sha256 and spans.

    One row per row (columns doc_id, text), doc_id being the path. Without
    ``ledger`` a new one in the shared folder is used. Spans are
    kind:start:end with an exclusive end, by start and then by the order of
    RULES. Null and empty texts have none; repeated rows get equal results;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ledger = ledger or staging_path(spark, "ledger")
    placed = update(docs.select(F.col("doc_id").alias("path"), "text"), ledger, rules)
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    span = F.struct("start", order.alias("o"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    base = order <= BASE
    counted = {f"n_{r.kind}": F.sum((F.col("kind") == r.kind).cast("long")) for r in rules[:BASE]}
    per_blob = findings(spark, ledger, rules).groupBy("blob").agg(
        *[x.alias(c) for c, x in counted.items()],
        F.array_join(F.array_sort(F.collect_list(F.when(base, span))).getField("s"), ",").alias("base_spans"),
        F.array_join(F.array_sort(F.collect_list(span)).getField("s"), ",").alias("spans"),
    )
    return placed.join(per_blob, "blob", "left").select(
        F.col("path").alias("doc_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counted],
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
