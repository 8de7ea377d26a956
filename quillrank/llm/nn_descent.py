"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Rows with equal vectors are one node. A first graph comes from a few orders of all vectors by the signs of random
projections, where blocks of neighbouring rows are compared. Each iteration then joins neighbours of neighbours: a
node's list and those that list it meet at the node with their vectors, pairs of them that were not compared before
are measured, and only pairs nearer than the farther one's worst neighbour leave the task, until hardly any list
changes. Lists hold ``K`` neighbours; of those that list a node the ``REVERSE`` nearest take part, which is the
sampling of the method and bounds what meets at a popular node.

A search keeps the ``BEAM`` nearest nodes found for each query and expands all that are not yet expanded, for all
queries at once, until every beam is expanded; it starts from the query's own node, if it has one, and from the
nearest of ``ENTRIES`` hash-chosen nodes.

Distances are Euclidean, in doubles, summed over one row at a time, so that a pair has one value everywhere.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id,
take no part; vectors of other lengths than the most frequent one (of equally frequent ones the longer) take no
part either; ties go to the smaller id; a query does not find itself but finds equal vectors; rows that repeat both
id and vector are candidates of their own, as queries they are one; further columns are ignored; a query with
fewer candidates gets all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import hash_limit, map_batches
from quillrank.operators.grouping import top_k_per_group
from quillrank.session import materialise

K, REVERSE = 32, 32
ORDERS, SIGNS, BLOCK = 4, 32, 64
BEAM = 256
#: Nodes from which searches start (about; chosen by hash), and how many of them each query takes.
ENTRIES, STARTS = 64, 2
#: Iterations end when at most this share of the list entries is new.
UNCHANGED = 0.02
SEED = 11
_EDGES = "u long, v long, d double"
_GRAPH = "node long, ids array<long>, ds array<double>, fresh array<boolean>"


@dataclass(frozen=True)
class Graph:
    """``nodes(node, hash, x, members)`` with up to ``most`` smallest ids each; ``links(node, ids)`` both ways."""

    nodes: DataFrame
    links: DataFrame
    most: int


def usable(vector: str) -> Column:
    """Whether a vector has a length and finite components that are not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, hash, x)`` of the rows that take part; a negative zero equals zero."""
    kept = df.where(usable(vector) & F.col(key).isNotNull())
    rows = kept.select(F.col(key).alias("vec_id"), F.transform(vector, lambda c: c + F.lit(0).cast("float")).alias("x"))
    return rows.withColumn("hash", F.xxhash64("x"))


def _usual_length(vectors: DataFrame) -> int:
    lengths = vectors.groupBy(F.size("x").alias("length")).count()
    row = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return row["length"] if row else 0


def make_nodes(vectors: DataFrame, most: int) -> DataFrame:
    """One row for each distinct vector, with its ``most`` smallest ids; a task's rows are cut before the shuffle."""
    first = top_k_per_group(vectors, ["hash", "x"], [F.col("vec_id")], most)
    nodes = first.groupBy("hash", "x").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    return materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "ann-nodes")


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(-1))


def _roughly(x: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of each matrix of a stack, rounded differently from place to place."""
    squares = (x * x).sum(-1)
    return squares[..., :, None] + squares[..., None, :] - 2 * (x @ np.swapaxes(x, -1, -2))


def _edge_batches(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(u), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(u[part]), pa.array(v[part]), pa.array(d[part])], ["u", "v", "d"]
        )


def _ordered_blocks(nodes: DataFrame, length: int, k: int, seed: int) -> DataFrame:
    """Edges to the ``k`` nearest in the node's block, for each of several orders by signs of projections."""
    means = nodes.agg(F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(length)]).alias("mean")).first()["mean"]
    centre = np.array(means, np.float64)
    planes = np.random.default_rng(seed).normal(size=(length, ORDERS * SIGNS))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                signs = ((_matrix(batch.column(1)) - centre) @ planes > 0).reshape(-1, ORDERS, SIGNS)
                codes = (signs * weights).sum(-1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(codes), pa.list_(pa.int64()))], ["node", "x", "codes"]
                )

    kind = dict(nodes.dtypes)["x"]
    coded = map_batches(nodes.select("node", "x"), code, f"node long, x {kind}, codes array<long>")
    ordered = coded.select("node", "x", F.posexplode("codes").alias("order", "code"))
    ordered = ordered.repartitionByRange("order", "code", "node").sortWithinPartitions("order", "code", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1)) if batch.num_rows else None
            for at in range(0, batch.num_rows, BLOCK):
                start = max(0, min(at, batch.num_rows - BLOCK))  # the last block of a batch is a full one too
                own, block = ids[start : start + BLOCK], x[start : start + BLOCK]
                rough = _roughly(block)
                np.fill_diagonal(rough, np.inf)
                taken = min(k, len(own) - 1)
                near = np.argpartition(rough, taken - 1, axis=1)[:, :taken] if taken else np.zeros((len(own), 0), int)
                u, v = np.repeat(np.arange(len(own)), near.shape[1]), near.ravel()
                keep = own[u] != own[v]
                u, v = u[keep], v[keep]
                yield from _edge_batches(own[u], own[v], _distance(block[u], block[v]))

    return map_batches(ordered.select("node", "x"), compare, _EDGES)


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """``(node, near)``: the ``k`` nearest of each node's edges, repeated edges once, nearest first."""
    once = edges.groupBy("u", "v").agg(F.min("d").alias("d"))
    best = top_k_per_group(once, ["u"], [F.col("d"), F.col("v")], k)
    return best.groupBy(F.col("u").alias("node")).agg(F.sort_array(F.collect_list(F.struct("d", "v"))).alias("near"))


def _merged(graph: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The lists of ``graph(node, x, ids, ds, fresh)`` with what was found; only what comes new is fresh."""
    joined = graph.join(found, "node", "left").withColumn("near", F.coalesce("near", F.array()))
    old = F.transform(
        F.arrays_zip("ds", "ids"), lambda e: F.struct(e["ds"].alias("d"), e["ids"].alias("v"), F.lit(False).alias("n"))
    )
    new = F.transform(
        F.filter("near", lambda e: ~F.array_contains("ids", e["v"])),
        lambda e: F.struct(e["d"].alias("d"), e["v"].alias("v"), F.lit(True).alias("n")),
    )
    both = joined.select("node", "x", F.slice(F.array_sort(F.concat(old, new)), 1, k).alias("both"))
    return both.select(
        "node",
        "x",
        F.col("both.v").alias("ids"),
        F.col("both.d").alias("ds"),
        F.col("both.n").alias("fresh"),
    )


def _both_ways(graph: DataFrame, reverse: int) -> DataFrame:
    """``(w, m, d, fresh)``: each node with its list and the ``reverse`` nearest that list it."""
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "ds", "fresh")).alias("e")).select(
        F.col("node").alias("w"), F.col("e.ids").alias("m"), F.col("e.ds").alias("d"), F.col("e.fresh").alias("fresh")
    )
    listing = edges.select(F.col("m").alias("w"), F.col("w").alias("m"), "d", "fresh")
    listing = top_k_per_group(listing, ["w"], [F.col("d"), F.col("m")], reverse).drop("rank")
    return edges.unionByName(listing)


def _met(graph: DataFrame, k: int, reverse: int) -> DataFrame:
    """Edges between the neighbours of a node that are nearer than the worst in the list they would enter."""
    worst = F.when(F.size("ds") < k, F.lit(float("inf"))).otherwise(F.get("ds", F.lit(k - 1)))
    vectors = graph.select(F.col("node").alias("m"), "x", worst.alias("worst"))
    meeting = _both_ways(graph, reverse).join(vectors, "m")
    grouped = meeting.groupBy("w").agg(F.collect_list(F.struct("m", "fresh", "worst", "x")).alias("all"))
    # Nodes without a fresh neighbour have nothing left to compare.
    grouped = grouped.where(F.exists("all", lambda e: e["fresh"]))
    columns = grouped.select("all.m", "all.fresh", "all.worst", F.flatten("all.x").alias("x"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _edge_batches(*_nearer_pairs(batch, k))

    return map_batches(columns, compare, _EDGES)


def _nearer_pairs(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All groups of a batch, padded to one size, compared in stacks."""
    sizes = np.diff(batch.column(0).offsets.to_numpy())
    ids, fresh, worst, x = (
        batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in range(4)
    )
    x = x.astype(np.float64).reshape(len(ids), -1)
    starts = np.cumsum(sizes) - sizes
    us, vs, ds = [], [], []
    for at in range(0, len(sizes), 256):
        count = sizes[at : at + 256]
        lane = np.arange(count.max())
        real = lane < count[:, None]
        place = np.where(real, starts[at : at + 256, None] + lane, 0)
        own, new = ids[place], fresh[place] & real
        distances = _roughly(x[place])
        compared = real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :])
        compared &= own[:, :, None] != own[:, None, :]
        bound = np.square(worst[place])[:, :, None] * (1 + 1e-9)
        group, a, b = np.nonzero(compared & (distances < bound))
        u, v = place[group, a], place[group, b]
        pairs = np.unique(np.stack([ids[u], ids[v]], 1), axis=0, return_index=True)[1]
        u, v = u[pairs], v[pairs]
        d = _distance(x[u], x[v])
        near = d < worst[u]
        us.append(ids[u[near]])
        vs.append(ids[v[near]])
        ds.append(d[near])
    return np.concatenate(us), np.concatenate(vs), np.concatenate(ds)


def build(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    reverse: int = REVERSE,
    most: int = 11,
    max_iterations: int = 12,
    seed: int = SEED,
    report: Callable[[int, int], None] | None = None,
) -> Graph:
    """The neighbour graph of all vectors; ``most`` is one more than the neighbours a search will ask for.

    ``report`` is told of each iteration's number and changed entries.
    """
    vectors = _vectors(df, key, vector)
    length = _usual_length(vectors)
    nodes = make_nodes(vectors.where(F.size("x") == length), most)
    n = nodes.count()
    if n == 0:
        return Graph(nodes, nodes.select("node", F.array().cast("array<long>").alias("ids")), most)
    none = {"ids": "array<long>", "ds": "array<double>", "fresh": "array<boolean>"}
    bare = nodes.select("node", "x", *[F.array().cast(kind).alias(name) for name, kind in none.items()])
    graph = materialise(_merged(bare, _lists(_ordered_blocks(nodes, length, k, seed), k), k), "ann-graph")
    for iteration in range(1, max_iterations + 1):
        graph = materialise(_merged(graph, _lists(_met(graph, k, reverse), k), k), "ann-graph")
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda f: f)))).first()[0]
        if report:
            report(iteration, changed)
        if changed <= UNCHANGED * n * k:
            break
    links = _both_ways(graph, reverse).groupBy(F.col("w").alias("node")).agg(F.collect_set("m").alias("ids"))
    return Graph(nodes, materialise(links, "ann-links"), most)


def _measured(pairs: DataFrame, asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(q, v, d)`` for pairs of query and node."""
    joined = pairs.join(nodes.select(F.col("node").alias("v"), F.col("x").alias("there")), "v").join(
        asked.select("q", F.col("x").alias("here")), "q"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distance(_matrix(batch.column(2)), _matrix(batch.column(3)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(d)], ["q", "v", "d"])

    return map_batches(joined.select("q", "v", "here", "there"), run, "q long, v long, d double")


def _starts(asked: DataFrame, graph: Graph) -> DataFrame:
    """The nearest entry nodes of each query, and its own node."""
    n = graph.nodes.count()
    entries = graph.nodes.where(F.xxhash64("node") <= hash_limit(ENTRIES, n)).select("node", "x").limit(8 * ENTRIES)
    rows = entries.collect()  # a bounded number
    own = asked.where(F.col("node").isNotNull()).select("q", F.col("node").alias("v"), F.lit(0.0).alias("d"))
    if not rows:
        return own
    ids, there = np.array([r["node"] for r in rows]), np.array([r["x"] for r in rows], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, here = batch.column(0).to_numpy(), _matrix(batch.column(1))
                d = np.stack([_distance(here, x) for x in there], 1)
                best = np.argsort(d, 1, kind="stable")[:, :STARTS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(q, best.shape[1])),
                        pa.array(ids[best].ravel()),
                        pa.array(np.take_along_axis(d, best, 1).ravel()),
                    ],
                    ["q", "v", "d"],
                )

    return own.unionByName(map_batches(asked.select("q", "x"), run, "q long, v long, d double"))


def search(graph: Graph, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", top_k: int = 10) -> DataFrame:
    """The ``top_k`` nearest found: ``(query_id, rank, vec_id, score)``; a query finds its own row never.

    ``top_k`` may be up to ``graph.most - 1``. Queries need not be in the graph.
    """
    if top_k >= graph.most:
        raise ValueError(f"the graph keeps {graph.most} ids of a vector: top_k must be below")
    rows = _vectors(queries, key, vector).distinct()
    known = graph.nodes.select("hash", "x", "node")
    asked = rows.join(known, ["hash", "x"], "left").withColumn("q", F.monotonically_increasing_id())
    length = graph.nodes.select(F.size("x").alias("n")).limit(1)
    asked = asked.join(F.broadcast(length), F.size("x") == F.col("n")).drop("n")
    asked = materialise(asked, "ann-queries")
    beam = _starts(asked, graph).groupBy("q", "v").agg(F.min("d").alias("d"))
    beam = materialise(beam.withColumn("done", F.lit(False)), "ann-beam")
    while not beam.where(~F.col("done")).isEmpty():
        frontier = beam.where(~F.col("done")).select("q", F.col("v").alias("node"))
        seen = frontier.join(graph.links, "node").select("q", F.explode("ids").alias("v")).distinct()
        unknown = seen.join(beam.select("q", "v"), ["q", "v"], "left_anti")
        new = _measured(unknown, asked, graph.nodes).withColumn("done", F.lit(False))
        both = beam.withColumn("done", F.lit(True)).unionByName(new)
        best = top_k_per_group(both, ["q"], [F.col("d"), F.col("v")], BEAM).drop("rank")
        beam = materialise(best, "ann-beam")
    members = graph.nodes.select(F.col("node").alias("v"), "members")
    found = beam.join(members, "v").join(asked.select("q", F.col("vec_id").alias("query_id"), "node"), "q")
    own = F.coalesce(F.col("v") == F.col("node"), F.lit(False)) & F.array_contains("members", F.col("query_id"))
    place = F.array_position("members", F.col("query_id"))
    others = F.filter("members", lambda m, i: ~own | (i != place - 1))
    found = found.select("q", "query_id", F.col("d").alias("score"), F.explode(others).alias("vec_id"))
    nearest = top_k_per_group(found, ["q"], [F.col("score"), F.col("vec_id")], top_k)
    return nearest.select("query_id", "rank", "vec_id", "score")
