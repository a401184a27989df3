"""Near-duplicate embeddings by range search on a robust-pruned flat graph.

*Points.* Equal vectors are one node. Where a bounded sample shows a dense
group, the nodes within half the link angle of its mean form a ball: any two
of them are linked, whatever their number. Balls and the other nodes are the
points of the graph, so a group that fills a third of the table is one point.

*Graph.* Points belong to their OVERLAP nearest cluster shards. Each shard
links its points to near and to random ones, robustly pruned; the lists of a
point from all its shards are united.

*Search.* Every point is a query in its PROBES nearest shards: a greedy beam
search from the shard's medoids, and from the point itself where it belongs to
the shard, then expansion of all that lies in range. Distances of found pairs
are verified in double precision. A pair with a ball is linked as a whole,
not at all, or member by member, in blocks; only sums leave a block.

*Audit.* Links of AUDIT nodes are counted by brute force. While the recall is
below LEAST_RECALL, the search is repeated in twice as many shards.

Shards are dealt out in pieces of bounded size, and all tasks hold one piece.
The driver sees the sample, SAMPLE vectors, and nothing that grows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.llm.near_duplicates import components
from perfwatch.session import stage

SIMILARITY = 0.95
#: Vectors that the driver sees, and the most cluster centres that it derives from them.
SAMPLE, CENTRES = 4096, 1024
#: Neighbours in the sample that make a dense group.
DENSE = 8
#: Points of a shard, on average and at most in one piece; queries of one task.
SHARD, PIECE, QUERIES = 2048, 4096, 8192
OVERLAP, PROBES = 2, 4
NEAR, FAR, ALPHA = 24, 8, 1.2
MEDOIDS, BEAM, OPENED, CHUNK = 4, 16, 4, 256
BLOCK = 2048
AUDIT, LEAST_RECALL = 256, 0.9
_SLACK = 1e-9


def _unit_rows(column: pa.Array) -> list[bytes | None]:
    """Unit vectors as bytes of doubles; None for vectors that link with nothing."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    out: list[bytes | None] = [None] * len(lengths)
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == size)
        x = values[starts[rows][:, None] + np.arange(size)]
        largest = np.abs(x).max(axis=1)
        good = np.isfinite(x).all(axis=1) & (largest > 0)
        x = x[good] / largest[good][:, None]
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        x += 0.0  # no negative zeros
        for row, vector in zip(rows[good], x, strict=True):
            out[row] = vector.tobytes()
    return out


def _units(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(_unit_rows(batch.column("embedding")), pa.binary())], names=["vec_id", "unit"])


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _by_size(units: list[bytes]):
    """(rows, matrix) of the vectors of each length."""
    sizes = np.array([len(u) for u in units])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _matrix([units[i] for i in rows])


def balls_of(x: np.ndarray, angle: float) -> np.ndarray:
    """Means of dense groups among the rows of ``x``, the densest first."""
    near = (x.astype(np.float32) @ x.T.astype(np.float32)) >= math.cos(angle)
    near = near.astype(np.float32)
    left = np.ones(len(x), bool)
    found = []
    while True:
        counts = near @ left.astype(np.float32)
        counts[~left] = 0
        if not len(counts) or counts.max() < DENSE:
            return np.array(found).reshape(len(found), x.shape[1])
        group = (near[int(counts.argmax())] > 0) & left
        centre = x[group].mean(axis=0)
        centre /= np.linalg.norm(centre)
        found.append(centre)
        left &= ~group & (x @ centre < math.cos(angle / 2))


def centres_of(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means over the rows of ``x``, five rounds from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(5):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], centres)
    return centres


def _enter_balls(balls: dict[int, np.ndarray], angle: float):
    """The ball of each node (its own node id where it is in none) and its angle to the centre."""
    def run(batches):
        for batch in batches:
            units = batch.column("unit").to_pylist()
            ball, off = np.full(len(units), -1), np.zeros(len(units))
            for rows, x in _by_size(units):
                centres = balls.get(x.shape[1])
                if centres is not None and len(centres):
                    cos = x @ centres.T
                    best = cos.argmax(axis=1)
                    away = np.arccos(np.clip(cos[np.arange(len(x)), best], -1, 1))
                    inside = away <= angle / 2 - 1e-6
                    ball[rows[inside]], off[rows[inside]] = best[inside], away[inside]
            sizes = np.array([len(u) for u in units]) // 8
            point = np.where(ball < 0, batch.column("node").to_numpy(), -1 - (sizes * SAMPLE + ball))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "copies", "unit")), pa.array(point), pa.array(off)], names=["node", "copies", "unit", "point", "off"]
            )

    return run


def _enter_shards(centres: dict[int, np.ndarray], overlap: int, probes: int):
    """A row for each of the nearest shards of a point; it belongs to the first ones."""
    def run(batches):
        for batch in batches:
            units = batch.column("unit").to_pylist()
            at, shard, member = [], [], []
            for rows, x in _by_size(units):
                own = centres.get(x.shape[1], np.zeros((1, x.shape[1])))
                order = np.argsort(-(x @ own.T), axis=1, kind="stable")[:, :probes]
                at.append(np.repeat(rows, order.shape[1]))
                shard.append(x.shape[1] * CENTRES + order.ravel())
                member.append(np.tile(np.arange(order.shape[1]) < overlap, len(rows)))
            if at:
                index = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(index) for c in ("point", "unit", "r")), pa.array(np.concatenate(shard)), pa.array(np.concatenate(member))],
                    names=["point", "unit", "r", "shard", "member"],
                )

    return run


def pruned(x: np.ndarray, rows: np.ndarray, candidates: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning: of each row's candidates the nearest, then the nearest that no chosen one stands before; -1 fills up."""
    cos = np.einsum("bd,bcd->bc", x[rows], x[candidates])
    cos[candidates == rows[:, None]] = -9
    order = np.argsort(-cos, axis=1, kind="stable")
    candidates, cos = np.take_along_axis(candidates, order, 1), np.take_along_axis(cos, order, 1)
    vectors = x[candidates]
    between = np.sqrt(np.maximum(0, 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))))
    away = np.sqrt(np.maximum(0, 2 - 2 * cos))
    alive = cos > -9
    chosen = np.zeros_like(alive)
    count = np.zeros(len(rows), int)
    for j in range(candidates.shape[1]):
        take = alive[:, j] & (count < degree)
        chosen[:, j] = take
        count += take
        alive &= ~(take[:, None] & (alpha * between[:, j] <= away))
    return np.where(chosen, candidates, -1)


def neighbours_of(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """The flat graph over the rows of ``x``: pruned near and random neighbours, and the nearest of those that chose a row."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    x = x.astype(np.float32)
    rng = np.random.default_rng(seed)
    near, far = min(2 * NEAR, n - 1), min(3 * FAR, n)
    edges = []
    for lo in range(0, n, CHUNK):
        rows = np.arange(lo, min(n, lo + CHUNK))
        cos = x[rows] @ x.T
        cos[np.arange(len(rows)), rows] = -9
        closest = np.argpartition(-cos, near - 1, axis=1)[:, :near]
        for candidates, degree in ((closest, NEAR), (rng.integers(0, n, (len(rows), far)), FAR)):
            kept = pruned(x, rows, candidates, degree)
            at, column = np.nonzero(kept >= 0)
            edges.append(np.stack([rows[at], kept[at, column]]))
    a, b = np.concatenate(edges, axis=1)
    cos = np.einsum("ed,ed->e", x[a], x[b])
    order = np.lexsort((-cos, b))
    place = np.arange(len(b)) - np.searchsorted(b[order], b[order])
    back = order[place < NEAR]
    both = np.unique(np.concatenate([a * n + b, b[back] * n + a[back]]))
    return np.split(both % n, np.searchsorted(both // n, np.arange(1, n)))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("point")
    points = group["point"].to_numpy()
    lists = neighbours_of(_matrix(group["unit"].tolist()))
    return pd.DataFrame({"point": points, "neighbours": [points[x] for x in lists]})


def range_search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, own: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of all found rows of ``x`` with a cosine of ``least`` (a value for each query) or more.

    ``own`` is the row of a query among ``x``, or -1. A greedy beam search
    starts at the medoids and at the own row; then all rows in range are
    opened, and those in range that they lead to.
    """
    n, x, queries = len(x), x.astype(np.float32), queries.astype(np.float32)
    graph = np.full((n, max([1, *map(len, lists)])), -1)
    for i, neighbours in enumerate(lists):
        graph[i, : len(neighbours)] = neighbours
    medoids = [int((x @ x.mean(axis=0)).argmax())]
    while len(medoids) < min(MEDOIDS, n):
        medoids.append(int((x @ x[medoids].T).max(axis=1).argmin()))
    found = []
    for lo in range(0, len(queries), CHUNK):
        q, start, limit = queries[lo : lo + CHUNK], own[lo : lo + CHUNK], least[lo : lo + CHUNK] - 1e-5
        size = len(q)
        seen, opened = np.zeros((size, n + 1), bool), np.zeros((size, n + 1), bool)
        beam = np.concatenate([np.tile(np.unique(medoids), (size, 1)), np.where(np.isin(start, medoids), -1, start)[:, None]], axis=1)
        cos = np.where(beam < 0, -9, np.einsum("qd,qbd->qb", q, x[beam]))
        seen[np.arange(size)[:, None], beam] = True
        hits = [np.stack([np.nonzero(cos >= limit[:, None])[0], beam[cos >= limit[:, None]]])]

        def step(at: np.ndarray, row: np.ndarray):
            """Open rows for queries: (query, neighbour, cosine) of neighbours not seen before; hits are noted."""
            opened[at, row] = True
            to = graph[row]
            query, to = np.repeat(at, to.shape[1]), to.ravel()
            new = (to >= 0) & ~seen[query, to]
            keys = np.unique(query[new] * (n + 1) + to[new])
            query, to = keys // (n + 1), keys % (n + 1)
            seen[query, to] = True
            value = np.einsum("ed,ed->e", q[query], x[to])
            near = value >= limit[query]
            hits.append(np.stack([query[near], to[near]]))
            return query, to, value

        while True:
            rank = np.argsort(-cos, axis=1, kind="stable")[:, :BEAM]
            beam, cos = np.take_along_axis(beam, rank, 1), np.take_along_axis(cos, rank, 1)
            waiting = (cos > -9) & ~opened[np.arange(size)[:, None], beam]
            waiting &= np.cumsum(waiting, axis=1) <= OPENED
            at, column = np.nonzero(waiting)
            if not len(at):
                break
            query, to, value = step(at, beam[at, column])
            place = np.arange(len(query)) - np.searchsorted(query, query)
            width = int(place.max(initial=-1)) + 1
            more, value_of = np.full((size, width), -1), np.full((size, width), -9.0, np.float32)
            more[query, place], value_of[query, place] = to, value
            beam, cos = np.concatenate([beam, more], axis=1), np.concatenate([cos, value_of], axis=1)
        while True:
            at, row = np.unique(np.concatenate(hits, axis=1), axis=1)
            closed = ~opened[at, row]
            if not closed.any():
                break
            step(at[closed], row[closed])
        found.append(np.stack([at + lo, row]))
    query, row = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
    return query, row


def _search(angle: float):
    """(a, b, whole): pairs of points within reach of each other; whole if all their nodes are linked."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        members = group[group["role"] == 0].drop_duplicates("point").sort_values("point")
        queries = group[group["role"] == 1].drop_duplicates("point")
        empty = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "whole": pd.Series(dtype="bool")})
        if members.empty or queries.empty:
            return empty
        points, asked = members["point"].to_numpy(), queries["point"].to_numpy()
        x, q = _matrix(members["unit"].tolist()), _matrix(queries["unit"].tolist())
        r, s = members["r"].to_numpy(), queries["r"].to_numpy()
        lists = []
        for neighbours in members["neighbours"]:
            at = np.minimum(np.searchsorted(points, neighbours), len(points) - 1)
            lists.append(at[points[at] == neighbours])
        at = np.minimum(np.searchsorted(points, asked), len(points) - 1)
        own = np.where(points[at] == asked, at, -1)
        i, j = range_search(x, lists, q, own, np.cos(np.minimum(math.pi, angle + s + r.max())))
        i, j = i[asked[i] != points[j]], j[asked[i] != points[j]]
        cos = np.einsum("ed,ed->e", q[i], x[j])
        away, radii = np.arccos(np.clip(cos, -1, 1)), s[i] + r[j]
        whole = np.where(radii == 0, cos >= math.cos(angle), away + radii <= angle - _SLACK)
        near = np.where(radii == 0, whole, away <= angle + radii + _SLACK)
        a, b = np.minimum(asked[i], points[j])[near], np.maximum(asked[i], points[j])[near]
        return pd.DataFrame({"a": a, "b": b, "whole": whole[near]})

    return run


def _compare(similar: float):
    """Nodes of one ball against nodes of its neighbours: sums by node, and the pairs of points that have a link."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["role"] == 0], group[group["role"] == 1]
        if left.empty or right.empty:
            return pd.DataFrame({"x": pd.Series(dtype="int64"), "y": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})
        linked = _matrix(left["unit"].tolist()) @ _matrix(right["unit"].tolist()).T >= similar
        with_node = pd.DataFrame({
            "x": np.concatenate([left["node"], right["node"]]), "y": pd.array([None] * len(group), "Int64"),
            "n": np.concatenate([linked @ right["copies"].to_numpy(), left["copies"].to_numpy() @ linked]),
        })
        points = np.unique(right["b"].to_numpy()[linked.any(axis=0)])
        links = pd.DataFrame({"x": np.full(len(points), group["a"].iloc[0]), "y": pd.array(points, "Int64"), "n": np.zeros(len(points), np.int64)})
        return pd.concat([with_node[with_node["n"] > 0], links], ignore_index=True)

    return run


def _shared_out(rows: DataFrame, probes: int, centres: dict[int, np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """Members (shard, piece, parts) and queries (shard, piece, part) of all shards."""
    entered = stage(rows.mapInArrow(_enter_shards(centres, OVERLAP, max(probes, OVERLAP)), "point long, unit binary, r double, shard long, member boolean"), "shards")
    sizes = entered.groupBy("shard").agg(
        F.ceil(F.sum(F.col("member").cast("long")) / PIECE).alias("pieces"), F.ceil(F.count("*") / QUERIES).alias("parts")
    )
    placed = entered.join(sizes, "shard")
    members = placed.filter("member").withColumn("piece", F.pmod(F.xxhash64("point"), "pieces"))
    queries = placed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("pieces", F.lit(1)) - 1))).withColumn(
        "part", F.pmod(F.xxhash64("point", F.lit(1)), "parts")
    )
    return members.select("shard", "piece", "parts", "point", "unit", "r"), queries.select("shard", "piece", "part", "point", "unit", "r")


def found_pairs(points: DataFrame, centres: dict[int, np.ndarray], similar: float = SIMILARITY, probes: int = PROBES) -> DataFrame:
    """(a, b, whole): pairs of ``points`` (point, unit, r) that the graph search finds, each once."""
    members, queries = _shared_out(points, probes, centres)
    lists = members.groupBy("shard", "piece").applyInPandas(_build, "point long, neighbours array<long>")
    united = lists.groupBy("point").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    columns = ["shard", "piece", "part", "role", "point", "unit", "r", "neighbours"]
    known = (
        members.join(united, "point").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("role", F.lit(0)).select(columns)
    )
    asked = queries.withColumn("role", F.lit(1)).withColumn("neighbours", F.lit(None).cast("array<long>")).select(columns)
    pairs = known.union(asked).groupBy("shard", "piece", "part").applyInPandas(_search(math.acos(similar)), "a long, b long, whole boolean")
    return pairs.groupBy("a", "b").agg(F.max("whole").alias("whole"))


def _member_links(pairs: DataFrame, placed: DataFrame, similar: float) -> DataFrame:
    """Pairs of a ball and a point that need their nodes: (x, null, n) links of node x, and (a, b, 0) points with a link."""
    blocks = lambda n: F.ceil(n / BLOCK)
    open_pairs = stage(pairs.filter("NOT whole").select("a", "b"), "open")
    nodes = placed.select("point", "node", "unit", "copies")
    right = stage(open_pairs.join(nodes.withColumnRenamed("point", "b"), "b"), "right")
    sizes = (
        nodes.groupBy("point").agg(blocks(F.count("*")).alias("rows")).withColumnRenamed("point", "a")
        .join(right.groupBy("a").agg(blocks(F.count("*")).alias("columns")), "a")
    )

    def dealt(rows: DataFrame, own: str, other: str, role: int) -> DataFrame:
        return (
            rows.withColumn(f"{own}_at", F.pmod(F.xxhash64("node"), own))
            .withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
            .select("a", "b", "rows_at", "columns_at", F.lit(role).alias("role"), "node", "unit", "copies")
        )

    left = nodes.withColumnRenamed("point", "a").join(sizes, "a").withColumn("b", F.lit(None).cast("long"))
    both = dealt(left, "rows", "columns", 0).union(dealt(right.join(sizes, "a"), "columns", "rows", 1))
    return both.groupBy("a", "rows_at", "columns_at").applyInPandas(_compare(similar), "x long, y long, n long")


def _true_links(units: list[bytes], similar: float):
    """Links of each of these vectors among the nodes of a task, by brute force."""
    def run(batches):
        counts = np.zeros(len(units), np.int64)
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            for rows, x in _by_size(batch.column("unit").to_pylist()):
                for asked, q in _by_size(units):
                    if q.shape[1] == x.shape[1]:
                        counts[asked] += (q @ x.T >= similar) @ copies[rows]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(units))), pa.array(counts)], names=["i", "n"])

    return run


def recall(nodes: DataFrame, links: DataFrame, similar: float = SIMILARITY, audit: int = AUDIT) -> float:
    """Share of the links of ``audit`` nodes (node, unit, copies) that ``links`` (node, n_links) has; 1 if they have none."""
    drawn = nodes.orderBy(F.xxhash64("unit", F.lit(3)), "node").limit(audit).select("node", "unit").collect()
    if not drawn:
        return 1.0
    truth = nodes.mapInArrow(_true_links([r["unit"] for r in drawn], similar), "i long, n long").agg(F.sum("n")).first()[0] - len(drawn)
    found = links.filter(F.col("node").isin([r["node"] for r in drawn])).agg(F.sum("n_links")).first()[0] or 0
    return found / truth if truth else 1.0


def near_duplicates(vectors: DataFrame, similar: float = SIMILARITY, probes: int = PROBES) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other rows with a cosine of ``similar`` or more,
    component_id is the smallest vec_id reachable by links, ``kept`` marks the
    rows that bear it. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing and are their own component.
    Vectors of different lengths are not compared. Equal vectors and repeated
    rows link with each other. A null vec_id is no smallest one unless its
    component has no other. An empty table gives an empty result; other columns are
    ignored.
    """
    angle = math.acos(similar)
    schema = T.StructType([T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("unit", T.BinaryType())])
    units = vectors.select("vec_id", "embedding").mapInArrow(_units, schema).withColumn("key", F.unhex(F.md5("unit")))
    rows = stage(units, "vectors")
    nodes = stage(
        rows.filter("key IS NOT NULL").groupBy("key").agg(F.first("unit").alias("unit"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    drawn = [r["unit"] for r in nodes.orderBy(F.xxhash64("key")).limit(SAMPLE).select("unit").collect()]
    sample = {x.shape[1]: x for _, x in _by_size(drawn)}
    balls = {size: balls_of(x, angle) for size, x in sample.items()}
    placed = stage(
        nodes.mapInArrow(_enter_balls(balls, angle), "node long, copies long, unit binary, point long, off double"), "placed"
    )
    centre_of = [(-1 - (size * SAMPLE + i), c.tobytes()) for size, found in balls.items() for i, c in enumerate(found)]
    centres_frame = nodes.sparkSession.createDataFrame(centre_of, "point long, unit binary")
    groups = placed.filter("point < 0").groupBy("point").agg(F.max("off").alias("r"), F.sum("copies").alias("size")).join(centres_frame, "point")
    single = placed.filter("point >= 0").select("point", "unit", F.lit(0.0).alias("r"), F.col("copies").alias("size"))
    points = stage(single.union(groups.select("point", "unit", (F.col("r") + 1e-9).alias("r"), "size")), "points")
    shards = min(CENTRES, -(-points.count() * OVERLAP // SHARD))
    share = max(1, sum(map(len, sample.values())))
    centres = {size: centres_of(x, max(1, shards * len(x) // share)) for size, x in sample.items()}
    while True:
        pairs = stage(found_pairs(points, centres, similar, probes), "pairs")
        by_node, between = _linked(pairs, points, placed, similar)
        if probes >= CENTRES or recall(nodes, by_node, similar) >= LEAST_RECALL:
            break
        probes *= 2
    labels = components(between)
    known = placed.join(labels.toDF("point", "label"), "point", "left").select("node", F.coalesce("label", "point").alias("label"))
    member = nodes.select("node", "key").join(by_node, "node").join(known, "node")
    found = stage(rows.select("vec_id", "key").join(member, "key", "left"), "members")
    smallest = found.groupBy("label").agg(F.min("vec_id").alias("component_id"))
    alone = F.col("label").isNull()
    return (
        found.join(smallest, "label", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _linked(pairs: DataFrame, points: DataFrame, placed: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """(node, n_links) of every node, and the links (a, b) between points."""
    whole = pairs.filter("whole")
    both = whole.select("a", "b").union(whole.select("b", "a")).toDF("point", "other")
    sizes = points.select(F.col("point").alias("other"), F.col("size").alias("n"))
    full = both.join(sizes, "other").groupBy("point").agg(F.sum("n").alias("full"))
    partly = stage(_member_links(pairs, placed, similar), "partly") if pairs.filter("NOT whole").limit(1).count() else None
    counted = placed.select("node", "point", "copies").join(points.select("point", "size"), "point").join(full, "point", "left")
    total = F.col("size") - 1 + F.coalesce("full", F.lit(0))
    links = whole.select("a", "b")
    if partly is not None:
        own = partly.filter("y IS NULL").groupBy(F.col("x").alias("node")).agg(F.sum("n").alias("some"))
        counted, total = counted.join(own, "node", "left"), total + F.coalesce("some", F.lit(0))
        links = links.union(partly.filter("y IS NOT NULL").select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()
    return stage(counted.select("node", total.alias("n_links")), "links"), links
