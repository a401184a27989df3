"""Near-duplicate classes by DartMinHash signatures and banded joins.

*Signature.* A document is a weighted set: its runs of ``k`` words, each
weighted by its number of occurrences. Every element owns a plane of weight
against rank, cut into cells (weights [0,1), [1,2), [2,4) ..., ranks alike). A
hash of element and cell gives the number of darts in the cell (Poisson, by
its area) and the weight, rank and coordinate of each. A document takes the
darts under its weights and keeps the earliest of each coordinate; rank cells
are opened only until all coordinates are filled. Two documents agree on a
coordinate with a probability equal to their weighted Jaccard similarity.

*Joins.* Equal texts are one node from the start. Nodes that agree on all rows
of a band meet in a bucket. First each bucket compares its nodes with its
first one. Buckets that still hold several classes then compare nodes of
different classes: every pair in buckets of up to ``SMALL`` nodes, and in
larger ones each node outside the largest class with two centres of the bucket,
drawn by hash anew each round. The draws only save work: once a round connects few of these
nodes, the larger buckets that still hold several classes are settled exactly.
Similar sets share one of their first occurrences in any fixed order
(a prefix filter; here the order is rarest first), so all nodes of these
buckets are joined on such occurrences, across classes. Candidates are checked on
the exact weighted Jaccard similarity of the whole texts, whose weighted sets
are made once; connected ones form
a class. A pair at the least similarity meets in 8 of the 20 buckets on
average and in none with a probability of 3e-5; all pairs across classes that
meet are compared, or cannot be similar.

No step collects documents, links or classes, and no group is handled by one
task alone: centres and class labels come from map-side aggregates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.llm import text as tx
from perfwatch.session import stage

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
SMALL = 24
#: Draws go on while a round joins at least this share of the nodes outside the largest class of their bucket.
WORTHWHILE = 0.5
#: Nodes of a shingle that share a salt; the others meet in other tasks.
SALTED = 1000
LEVEL_BITS = np.uint64(58)
_cdf: dict[float, np.ndarray] = {}


def _darts(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts from uniform values, by the inverse of the distribution function."""
    if mean not in _cdf:
        top = int(mean + 12 * math.sqrt(mean) + 20)
        log = np.array([i * math.log(mean) - mean - math.lgamma(i + 1) for i in range(top)])
        _cdf[mean] = np.cumsum(np.exp(log))
    return np.searchsorted(_cdf[mean], u, "right")


def _throw(sig, k, element, weight, doc, v, rank_level):
    """The darts of one weight level and one rank level, into ``sig`` (documents x k)."""
    low, width = (0.0, 1.0) if v == 0 else (2.0 ** (v - 1), 2.0 ** (v - 1))
    area = width * (1.0 if rank_level == 0 else 2.0 ** (rank_level - 1))
    cell = tx.mix(element ^ tx.mix(np.array([v * 64 + rank_level + 1], np.uint64)))
    n = _darts((cell >> np.uint64(11)) * 2.0**-53, area)
    n = np.where(n > 0, n, 0)
    at = np.repeat(np.arange(len(n)), n)
    if not len(at):
        return
    nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    dart = tx.mix(cell[at] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    more = tx.mix(dart ^ np.uint64(0x632BE59BD9B4E019))
    if v:
        under = low + width * ((more >> np.uint64(32)) * 2.0**-32) < weight[at]
        at, dart, more = at[under], dart[under], more[under]
    coordinate = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)
    value = (np.uint64(rank_level) << LEVEL_BITS) | (dart >> np.uint64(6))
    np.minimum.at(sig, doc[at] * k + coordinate.astype(np.int64), value)


def signatures(words: tx.Words, k_words: int, k: int) -> np.ndarray:
    """DartMinHash signatures (documents x k); a document without words keeps the largest value."""
    docs = len(words.counts)
    doc, element, weight = tx.weighted_elements(words, k_words)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full(docs * k, none, np.uint64)
    total = np.bincount(doc, weight, docs)
    need = k * (math.log(k) + 1) / np.maximum(total, 1)
    level = np.maximum(0, np.ceil(np.log2(need))).astype(int)
    level[total == 0] = -1
    opened = np.full(docs, -1)
    while True:
        target = level[doc]
        top = int(level.max(initial=-1))
        for r in range(top + 1):
            use = (target >= r) & (opened[doc] < r)
            if not use.any():
                continue
            e, w, d = element[use], weight[use], doc[use]
            _throw(sig, k, e, w, d, 0, r)
            v = 1
            while True:
                heavy = w > (1 if v == 1 else 2 ** (v - 1))
                if not heavy.any():
                    break
                e, w, d = e[heavy], w[heavy], d[heavy]
                _throw(sig, k, e, w, d, v, r)
                v += 1
        opened = level.copy()
        open_docs = (sig.reshape(docs, k) == none).any(axis=1) & (total > 0)
        if not open_docs.any():
            return sig.reshape(docs, k)
        level[open_docs] += 1


def _sketch(k_words: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            parts = []
            for _, _, data, offsets in tx.slices(tx.pc.utf8_lower(batch.column("text"))):
                words = tx.Words(data, offsets, tx.NOT_SPACE)
                sig = signatures(words, k_words, bands * rows).reshape(-1, bands, rows)
                key = np.zeros(sig.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
                for r in range(rows):
                    key = tx.mix(key ^ sig[:, :, r])
                parts.append((key.astype(np.uint64).view(np.int64), words.counts))
            keys = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, bands), np.int64)
            counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(counts.astype(np.int64)), lists],
                names=["doc_id", "key", "n_words", "bands"],
            )

    return run


def _bags(k_words: int):
    """The weighted set of each text, sorted by hash, as bytes; one for each node of a task."""
    def run(batches):
        seen = set()
        for batch in batches:
            # A repeated row brings its node again.
            new = [i for i, x in enumerate(batch.column("node").to_pylist()) if not (x in seen or seen.add(x))]
            if len(new) < len(batch):
                batch = batch.take(pa.array(new, pa.int64()))
            for low, high, data, offsets in tx.slices(tx.pc.utf8_lower(batch.column("text"))):
                hashes, weights = [], []
                words = tx.Words(data, offsets, tx.NOT_SPACE)
                doc, element, weight = tx.weighted_elements(words, k_words)
                edges = np.searchsorted(doc, np.arange(len(words.counts) + 1))
                weight = weight.astype(np.int32)
                for x, y in zip(edges[:-1], edges[1:], strict=True):
                    hashes.append(element[x:y].tobytes())
                    weights.append(weight[x:y].tobytes())
                node = batch.column("node").slice(low, high - low)
                yield pa.RecordBatch.from_arrays([node, pa.array(hashes, pa.binary()), pa.array(weights, pa.binary())], names=["node", "h", "w"])

    return run


def overlap(h: np.ndarray, w: np.ndarray, g: np.ndarray, v: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets with sorted hashes."""
    if len(h) > len(g):
        h, w, g, v = g, v, h, w
    at = np.minimum(np.searchsorted(g, h), len(g) - 1)
    hit = g[at] == h
    shared = int(np.minimum(w[hit], v[at[hit]]).sum())
    return shared / (int(w.sum()) + int(v.sum()) - shared)


def _verify(least: float):
    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("h_a", "w_a", "h_b", "w_b")]
            keep = [
                overlap(np.frombuffer(h.as_py(), np.uint64), np.frombuffer(w.as_py(), np.int32), np.frombuffer(g.as_py(), np.uint64), np.frombuffer(v.as_py(), np.int32)) >= least
                for h, w, g, v in zip(*columns, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _star(rows: DataFrame, similar: float) -> DataFrame:
    """Every node with the first node of each of its buckets."""
    first = F.min(F.struct(F.col("node").alias("other"), F.col("n").alias("m"))).alias("c")
    return _pairs(rows, rows.groupBy("bucket").agg(first).select("bucket", "c.other", "c.m"), similar, F.lit(True))


def _pairs(rows: DataFrame, centres: DataFrame, similar: float, condition: Column) -> DataFrame:
    """Different nodes that meet in a bucket and are near enough in size to be similar."""
    sizes = F.least("n", "m") >= F.greatest("n", "m") * (similar - 1e-9)
    return (
        rows.join(centres, "bucket").filter((F.col("node") != F.col("other")) & sizes & condition)
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    )


def _mixed(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """``placed`` in buckets of several classes, with label, bucket size, and ``main``: the largest class of the bucket."""
    known = placed.join(labels, "node")
    classes = known.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    buckets = classes.groupBy("bucket").agg(
        F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("classes")
    ).filter("classes > 1")
    return known.join(buckets.select("bucket", "size", F.col("most.label").alias("main")), "bucket")


def _across(rows: DataFrame, similar: float, turn: int) -> DataFrame:
    """Pairs of different classes in mixed buckets.

    Every pair in a bucket of up to SMALL nodes, at the first turn; in a larger
    one each node outside the main class with two centres, drawn by hash: one of the main class and one of the others.
    """
    centre = F.struct("node", "n", "label")
    dice = F.xxhash64("node", "bucket", F.lit(turn))
    drawn = (
        rows.filter(F.col("size") > SMALL).groupBy("bucket", (F.col("label") == F.col("main")).alias("within"))
        .agg(F.min_by(centre, dice).alias("c")).select("bucket", "c.node", "c.n", "c.label")
    )
    if not turn:
        drawn = drawn.union(rows.filter(F.col("size") <= SMALL).select("bucket", "node", "n", "label"))
    return _pairs(rows.filter("label <> main"), drawn.toDF("bucket", "other", "m", "other_label"), similar, F.col("label") != F.col("other_label"))


def _prefixes(similar: float):
    """The occurrences of each weighted set that a similar set must share one of, with their places: useful ones, rarest first."""
    def run(batches):
        for batch in batches:
            parts = []
            for row, (n, elements) in enumerate(zip(batch.column("n").to_pylist(), batch.column("elements"), strict=True)):
                weight = elements.values.field("w").to_numpy(zero_copy_only=False)
                # What is not listed comes first in the order.
                alone = n - int(weight.sum())
                length = max(0, n - math.ceil(similar * n - 1e-9) + 1 - alone)
                at = np.repeat(np.arange(len(weight)), weight)[:length]
                starts = np.cumsum(weight) - weight
                parts.append((np.full(len(at), row), elements.values.field("h").to_numpy(zero_copy_only=False)[at],
                              np.arange(len(at)) - starts[at], alone + np.arange(len(at)), elements.values.field("df").to_numpy(zero_copy_only=False)[at]))
            if parts:
                row, h, nth, place, df = (np.concatenate(x) for x in zip(*parts, strict=True))
                columns = [batch.column(c).take(pa.array(row)) for c in ("node", "n", "label", "outside")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(pa.array(x.astype(np.int64)) for x in (h, nth, place, df))],
                    names=["node", "n", "label", "outside", "h", "nth", "place", "df"],
                )

    return run


def _elements(batches):
    """The shingles of weighted sets, one a row."""
    for batch in batches:
        nodes, outside = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "outside"))
        for low in range(0, len(batch), 500):
            part = batch.slice(low, 500)
            h, w = (np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in (("h", np.int64), ("w", np.int32)))
            n = [len(x) // 8 for x in part.column("h").to_pylist()]
            node, out = nodes[low : low + 500], outside[low : low + 500]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(node, n)), pa.array(np.repeat(out, n)), pa.array(h), pa.array(w)], names=["node", "outside", "h", "w"]
            )


def _open_pairs(rows: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Every pair of different classes that may be similar, one of them outside the main class of a larger mixed bucket.

    Shingles of many nodes are salted: one side is dealt out, the other one repeated.
    """
    nodes = rows.filter(F.col("size") > SMALL).groupBy("node", "n", "label").agg(F.max(F.col("label") != F.col("main")).alias("outside"))
    elements = stage(bags.join(nodes.select("node", "outside"), "node").mapInArrow(_elements, "node long, outside boolean, h long, w int"), "elements")
    # Shingles of one node only, or of no outside node, bring no pair: they come first in the order and are not listed.
    useful = elements.groupBy("h").agg(F.count("*").alias("df"), F.max("outside").alias("meets")).filter("df > 1 AND meets").select("h", "df")
    known = elements.drop("outside").join(useful, "h")
    ordered = known.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h", "w"))).alias("elements"))
    starts = stage(
        ordered.join(nodes, "node").mapInArrow(
            _prefixes(similar), "node long, n long, label long, outside boolean, h long, nth long, place long, df long"
        ),
        "prefixes",
    )
    salts = (1 + F.floor(F.col("df") / SALTED)).cast("long")
    left = starts.filter("outside").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    right = starts.withColumn("salt", F.pmod(F.xxhash64("node"), salts)).select(
        "h", "nth", "salt", F.col("node").alias("other"), F.col("n").alias("m"), F.col("label").alias("other_label"), F.col("place").alias("spot")
    )
    sizes = F.least("n", "m") >= F.greatest("n", "m") * (similar - 1e-9)
    # At the first shared occurrence nothing before it is shared: what stands from there on must suffice.
    rest = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("spot"))
    enough = F.min_by("rest", "place") * (1 + similar) >= similar * F.max("both") - 1e-6
    # The rest only shrinks along the order, so where it does not suffice the pair goes before it is grouped.
    may = rest * (1 + similar) >= similar * (F.col("n") + F.col("m")) - 1e-6
    met = left.join(right, ["h", "nth", "salt"]).filter((F.col("label") != F.col("other_label")) & sizes & may)
    return (
        met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), (F.col("n") + F.col("m")).alias("both"), "place", rest.alias("rest"))
        .groupBy("a", "b").agg(enough.alias("enough")).filter("enough").select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label) with label the smallest node of the component; nodes without links are absent.

    Labels spread along links and jump to the label of the label, so a chain of
    n links takes about log n rounds. Each round is stored, which cuts lineage.
    """
    edges = stage(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = stage(edges.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")), "labels")
    while True:
        near = edges.join(labels.toDF("other", "near"), "other").groupBy("node").agg(F.min("near").alias("near"))
        spread = labels.join(near, "node").select("node", F.least("label", "near").alias("mid"), F.col("label").alias("old"))
        jump = labels.toDF("mid", "far")
        following = stage(
            spread.join(jump, "mid", "left").select("node", F.least("mid", F.coalesce("far", "mid")).alias("label"), "old"), "labels"
        )
        changed = following.filter("label <> old").limit(1).count()
        labels = following.select("node", "label")
        if not changed:
            return labels


def _key(text: str = "text"):
    return F.unhex(F.md5(text))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the classes that ``links`` connect have become one."""
    a, b = labels.toDF("a", "la"), labels.toDF("b", "lb")
    between = links.join(a, "a").join(b, "b").filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    roots = components(between).toDF("label", "root")
    return stage(labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "classes")


def near_duplicates(
    docs: DataFrame, k_words: int = WORDS, similar: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text): doc_id, class_id, class_size, keeps.

    class_id is the smallest doc_id of the class, class_size its rows. ``keeps``
    marks the rows of the document that stands for its class. Texts that are
    null, empty or without a word belong to no class: class_id is their own
    doc_id, class_size 1, and keeps is true. Equal texts always share a class.
    Repeated rows count as copies. Words are cut at ASCII white space, case is
    ignored, texts under ``k_words`` words are one shingle. An empty table
    gives an empty result; other columns are ignored.
    """
    return _classes(docs, k_words, similar, bands, rows).drop("key")


def _classes(
    docs: DataFrame, k_words: int = WORDS, similar: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    base = docs.select("doc_id", _key().alias("key"), "text")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("key", T.BinaryType()),
        T.StructField("n_words", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])
    sketch = stage(base.mapInArrow(_sketch(k_words, bands, rows), schema), "sketch")
    nodes = stage(
        sketch.filter("n_words > 0").groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.max("n_words").alias("n_words"))
        .select("key", "doc_id", "copies", "bands", F.greatest(F.lit(1), F.col("n_words") - (k_words - 1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    placed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("bucket")
    placed = stage(placed.join(shared, "bucket"), "placed")
    wanted = nodes.join(placed.select("node").distinct(), "node").select("node", "key", "doc_id")
    match = (F.col("d.key") == F.col("w.key")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    texts = base.alias("d").join(wanted.alias("w"), match).select("node", "text")
    bags = stage(texts.mapInArrow(_bags(k_words), "node long, h binary, w binary"), "bags")

    def links_of(pairs: DataFrame) -> DataFrame:
        both = pairs.join(bags.toDF("a", "h_a", "w_a"), "a").join(bags.toDF("b", "h_b", "w_b"), "b")
        return stage(both.select("a", "b", "h_a", "w_a", "h_b", "w_b").mapInArrow(_verify(similar), "a long, b long"), "links")

    labels = _merged(nodes.select("node", F.col("node").alias("label")), links_of(_star(placed, similar)))
    turn = 0
    while True:
        mixed = stage(_mixed(placed, labels), "mixed")
        outside = mixed.filter((F.col("size") > SMALL) & (F.col("label") != F.col("main"))).select("node").distinct().count()
        if turn and (not outside or before - outside < WORTHWHILE * before):
            break
        before = outside
        links = links_of(_across(mixed, similar, turn))
        if links.limit(1).count():
            labels = _merged(labels, links)
        turn += 1
    if outside:
        labels = _merged(labels, links_of(_open_pairs(mixed, bags, similar)))
    own = nodes.join(labels, "node").select("key", "doc_id", "copies", "label")
    classes = own.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    known = own.select("key", "label").join(classes, "label").select("key", "class_id", "class_size")
    out = sketch.join(known, "key", "left")
    grouped = F.col("n_words") > 0
    return out.select(
        "doc_id",
        "key",
        F.when(grouped, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.when(grouped, F.col("doc_id").eqNullSafe(F.col("class_id"))).otherwise(True).alias("keeps"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class; repeated rows of such a document are one.

    Rows are told apart by doc_id and text, so null or repeated ids lose no other document.
    """
    found = stage(_classes(docs), "classes")

    def listed(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        match = (_key("l.text") == F.col("r.key")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        return rows.alias("l").join(ids.select("doc_id", "key").alias("r"), match, how)

    kept = listed(docs, found.filter("NOT keeps").distinct(), "left_anti")
    repeated = found.filter("keeps AND class_size > 1").groupBy("doc_id", "key").count().filter("count > 1")
    if not repeated.limit(1).count():
        return kept
    return listed(kept, repeated, "left_anti").union(listed(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
