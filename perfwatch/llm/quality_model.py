"""Quality classifier by hierarchical empirical Bayes.

*Document evidence.* Naive Bayes over hashed words and a few binned features
of the form of a text (symbols, capitals, repeats, word length, size), with
class counts over all labelled documents that are not used for calibration. The
log-odds are averaged over the words, so long texts are not overconfident, and
a slope and an intercept fitted on the other labelled documents turn them into
calibrated log-odds.

*Site priors.* Labelled documents are counted by host and by path. The share
of good documents of a path is shrunk to that of its host, and that of the
host to the global one; the strengths are estimated from the spread of the
shares between sites (method of moments), so sparse sites stay near the global
prior and large ones keep their own rate.

*Posterior.* log-odds = site posterior of the path + calibrated evidence.

Counts are grouped aggregates with map-side sums; a host with a third of all
rows is one row after them. Only the word table (``2**BITS`` rows at most)
and the calibration (one row for each of ``BINS`` score bins) come to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.llm import text as tx
from perfwatch.session import stage

BITS = 17
BINS = 200
FORM = 64
NONE = "none"
_SIGN = np.array([chr(b) in "#*$%&|<>{}[]_=+~^@!" for b in range(256)])
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def _level(share: np.ndarray) -> np.ndarray:
    """Eight levels of a share, finer near 0."""
    return np.searchsorted([0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7], share, "right")


def _features(column: pa.Array):
    """(first row, rows, document, word feature, form features, words) of runs of documents.

    Words are distinct within a document; every document has six form features, numbered under FORM.
    """
    for low, high, data, offsets in tx.slices(column):
        docs = high - low
        folded = np.where(_UPPER[data], data + np.uint8(32), data).astype(np.uint8)
        words = tx.Words(folded, offsets, tx.ALNUM)
        sizes = np.maximum(np.diff(offsets), 1)

        def share(table, data=data, offsets=offsets, sizes=sizes):
            total = np.append(0, np.cumsum(table[data]))
            return np.diff(total[offsets]) / sizes

        hashed = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
        key = np.unique(words.doc * (1 << BITS) + hashed)
        doc, feature = key >> BITS, key & ((1 << BITS) - 1)
        distinct = np.bincount(doc, minlength=docs)
        mean = np.bincount(words.doc, words.end - words.start, docs) / np.maximum(words.counts, 1)
        form = [
            _level(share(_SIGN)), 8 + _level(share(_UPPER)), 16 + _level(1 - share(_LETTER)),
            24 + np.minimum(7, mean.astype(int) // 2), 32 + np.minimum(7, np.log2(words.counts + 1).astype(int) // 2),
            40 + np.minimum(7, (8 * distinct / np.maximum(words.counts, 1)).astype(int)),
        ]
        yield low, docs, doc, FORM + feature, np.stack(form, axis=1), words.counts


def _count(batches):
    """Documents with each feature, by label: one row per feature and task; feature -1 counts documents."""
    table = np.zeros((2, FORM + (1 << BITS)), np.int64)
    docs = np.zeros(2, np.int64)
    for batch in batches:
        good = batch.column("good").to_numpy(zero_copy_only=False).astype(int)
        docs += np.bincount(good, minlength=2)
        for low, n, doc, feature, form, _ in _features(batch.column("text")):
            y = good[low : low + n]
            np.add.at(table, (y[doc], feature), 1)
            np.add.at(table, (np.repeat(y, form.shape[1]), form.ravel()), 1)
    at = np.flatnonzero(table.any(axis=0))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(table[0, at], docs[0])), pa.array(np.append(table[1, at], docs[1])),
    ], names=["feature", "bad", "good"])


def evidence_table(training: DataFrame) -> tuple[np.ndarray, float]:
    """Log-likelihood ratios of all features, and the global share of good documents (``text``, ``good``).

    Features seen fewer than three times say nothing.
    """
    counted = training.select("text", "good").mapInArrow(_count, "feature int, bad long, good long")
    rows = counted.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    docs = rows[rows.feature < 0]
    bad, good = int(docs.bad.sum()), int(docs.good.sum())
    table = np.zeros(FORM + (1 << BITS), np.float32)
    rows = rows[(rows.feature >= 0) & (rows.bad + rows.good >= 3)]
    if bad and good:
        # Both rates are shrunk to the common one, by the weight of one document.
        rate = (rows.bad + rows.good) / (bad + good)
        table[rows.feature] = np.log((rows.good + 2 * rate) / (good + 2)) - np.log((rows.bad + 2 * rate) / (bad + 2))
    return table, (good + 1) / (bad + good + 2)


def _score(table: np.ndarray):
    def run(batches):
        for batch in batches:
            scores = []
            for _, n, doc, feature, form, counts in _features(batch.column("text")):
                told = table[feature]
                words = np.bincount(doc, told, n) / np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1))
                scores.append(np.where(counts > 0, words + table[form].sum(axis=1), 0.0))
            flat = np.concatenate(scores) if scores else np.zeros(0)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(flat, pa.float64())], names=[*[batch.schema.names[i] for i in keep], "raw"]
            )

    return run


def calibrate(score: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log-odds of good against scores, by Newton steps on counts with a weak prior."""
    w = np.array([1.0, 0.0])
    x = np.stack([score, np.ones(len(score))], axis=1)
    n = good + bad
    if not len(score) or not good.sum() or not bad.sum():
        return 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (good - n * p) - 0.01 * w
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(h, g)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _strength(groups: DataFrame, parent: Column) -> float:
    """Pseudo-counts of a Beta prior around ``parent``, from the spread of the shares of groups (n, good)."""
    n, share = F.col("n"), F.col("good") / F.col("n")
    spread = groups.filter(n > 1).agg(
        F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n * (share - parent) * (share - parent)).alias("between"),
        F.sum(n * parent * (1 - parent) / n).alias("noise"), F.sum(n * parent * (1 - parent)).alias("scale"),
    ).first()
    if not spread.n or spread.k < 2 or not spread.scale:
        return 10.0
    # Expected: sum n (share - parent)^2 = noise + (sum n - k) * variance; variance = p (1 - p) / (strength + 1).
    variance = (spread.between - spread.noise) / max(spread.n - spread.k, 1)
    typical = spread.scale / spread.n
    return float(min(1e4, max(1.0, typical / variance - 1))) if variance > typical / 1e4 else 1e4


def site_posteriors(labelled: DataFrame, prior: float) -> tuple[DataFrame, DataFrame]:
    """(host, host_rate) and (host, path, path_n, path_rate): shares of good documents, shrunk level by level."""
    paths = stage(labelled.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k = _strength(hosts, F.lit(prior))
    hosts = hosts.select("host", ((F.col("good") + k * prior) / (F.col("n") + k)).alias("host_rate"))
    known = paths.join(hosts, "host")
    k = _strength(known, F.col("host_rate"))
    return hosts, known.select(
        "host", "path", F.col("n").alias("path_n"), ((F.col("good") + k * F.col("host_rate")) / (F.col("n") + k)).alias("path_rate")
    )


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, cut: float = 0.5) -> DataFrame:
    """doc_id, host, path, evidence, prior, quality (posterior of being good) and kept of every document.

    One row per row (docs: doc_id, text; labels: doc_id, quality). ``host`` and
    ``path`` default to the source and its language section. A site without
    labels has the rate of the level above. Null hosts and paths are a site of
    their own. Null and empty texts have evidence 0 before calibration. A
    document with several labels is good only if all are 1; null labels count
    for nothing; without labels of both kinds everything gets the prior.
    Repeated rows get equal results; other columns are ignored.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    base = docs.select(
        "doc_id", F.coalesce(host.cast("string"), F.lit(NONE)).alias("host"), F.coalesce(path.cast("string"), F.lit(NONE)).alias("path"), "text"
    )
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    for_calibration = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5)) == 0
    # Labels grow with the documents, so they are not broadcast: texts meet their labels in one exchange by id.
    table, prior = evidence_table(base.filter(~for_calibration).join(known.hint("merge"), "doc_id"))
    schema = T.StructType([*base.schema.fields[:3], T.StructField("raw", T.DoubleType())])
    scored = stage(base.mapInArrow(_score(table), schema), "scored")
    labelled = stage(scored.join(known, "doc_id"), "labelled")
    ends = labelled.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).first()
    width = ((ends.hi or 0.0) - (ends.lo or 0.0)) / BINS or 1.0
    bins = (
        labelled.filter(for_calibration).groupBy(F.floor((F.col("raw") - (ends.lo or 0.0)) / width).alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.sum(F.col("good").cast("double")).alias("good"), F.count("*").alias("n")).toPandas()
    )
    slope, shift = calibrate(bins.raw.to_numpy(float), bins.good.to_numpy(float), (bins.n - bins.good).to_numpy(float))
    if slope or shift:
        shift -= float(np.log(prior / (1 - prior)))
    hosts, paths = site_posteriors(labelled, prior)
    joined = scored.join(hosts, "host", "left").join(paths, ["host", "path"], "left")
    rate = F.coalesce("path_rate", "host_rate", F.lit(prior))
    evidence = F.col("raw") * slope + shift
    quality = 1 / (1 + F.exp(-(_logit(rate) + evidence)))
    return joined.select(
        "doc_id", "host", "path", evidence.alias("evidence"), rate.alias("prior"), quality.alias("quality"), (quality >= cut).alias("kept")
    )
