"""Regression trees of an exact number of leaves, grown best first from histograms.

Features are cut into at most 255 bins once. A tree is grown on the driver from sums of gradient, curvature and rows
by ``(node, feature, bin)``, a table whose size depends on the tree and the bins alone.
Each pass over the rows gathers the histograms of one child of every leaf that may still be split, the smaller one;
its sibling's is the parent's less that. Of a node with no more rows than a histogram has places, the rows
themselves are gathered, and what lies below it needs no further pass. A heap then splits the leaf of the highest gain, as long as the histograms
of its children are known, until there are ``num_leaves`` leaves. A leaf beyond the number of splits that are left
cannot be reached and is not looked into, so a tree takes about as many passes as it is deep.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import astuple, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_BINS = 255
# Accuracy of the approximate quantiles that part the bins.
_QUANTILE_ACCURACY = 10_000
# A split must gain more than rounding can make up.
MIN_GAIN = 1e-9
# The sums of up to this many tasks are added up by the driver; those of more by a shuffle.
FEW_PARTITIONS = 16
_BINS = T.ArrayType(T.ShortType())
_SUMS = (
    T.StructType()
    .add("node", T.IntegerType())
    .add("place", T.IntegerType())
    .add("g", T.DoubleType())
    .add("h", T.DoubleType())
    .add("n", T.LongType())
    .add("bins", _BINS)
)
_NODE_TYPES = {"g": T.DoubleType(), "h": T.DoubleType(), "n": T.LongType(), "gain": T.DoubleType()}
NODES = T.StructType(
    [
        T.StructField(name, _NODE_TYPES.get(name, T.IntegerType()))
        for name in ("tree", "node", "g", "h", "n", "feature", "bin", "gain", "left", "right")
    ]
)
STEPS = T.StructType().add("bins", _BINS).add("gradient", T.DoubleType()).add("curvature", T.DoubleType())


def bin_edges(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS, min_data_in_bin: int = 1) -> list[list[float]]:
    """Upper edges of all bins but the last of each feature: quantiles, less those that leave a bin too few rows."""
    shares = [i / max_bins for i in range(max_bins + 1)]
    quantiles = rows.agg(
        *[F.percentile_approx(F.col(name), shares, _QUANTILE_ACCURACY).alias(f"q{i}") for i, name in enumerate(features)]
    ).first()
    edges = [sorted({float(v) for v in quantiles[f"q{i}"] or []})[:-1] for i in range(len(features))]
    if min_data_in_bin <= 1:
        return edges
    places = [(i, len(own) + 1) for i, own in enumerate(edges)]
    bins = rows.select(
        *[_bin(F.col(name), own).alias(f"b{i}") for i, (name, own) in enumerate(zip(features, edges))]
    )
    exploded = bins.select(F.posexplode(F.array(*[F.col(f"b{i}") for i in range(len(features))])).alias("f", "b"))
    counts = {(row["f"], row["b"]): row["count"] for row in exploded.groupBy("f", "b").count().collect()}
    return [_merged(edges[i], [counts.get((i, b), 0) for b in range(n)], min_data_in_bin) for i, n in places]


def _bin(value, edges: Sequence[float]):
    """Number of edges below the value, by halves."""
    if not edges:
        return F.lit(0)

    def search(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= edges[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(edges))


def _merged(edges: list[float], counts: list[int], least: int) -> list[float]:
    """The edges that close a bin of at least ``least`` rows; what is left joins the last bin."""
    kept, held = [], 0
    for edge, count in zip(edges, counts):
        held += count
        if held >= least:
            kept.append(edge)
            held = 0
    if kept and held + counts[-1] < least:
        kept.pop()
    return kept


def with_bins(rows: DataFrame, values: str, edges: Sequence[Sequence[float]]) -> DataFrame:
    """``bins array<short>`` in place of the array of feature values."""
    limits = [np.array(own, np.float64) for own in edges]
    schema = rows.drop(values).schema.add("bins", _BINS)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(values).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(limits))
            bins = np.stack([np.searchsorted(own, x[:, i], "left") for i, own in enumerate(limits)], 1)
            flat = pa.array(bins.astype(np.int16).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(limits))
            columns = {name: batch.column(name) for name in names if name != "bins"}
            columns["bins"] = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return rows.mapInArrow(run, schema)


@dataclass
class Node:
    """A node with its sums; ``feature`` is -1 in a leaf. Rows whose bin is at most ``bin`` go left."""

    g: float
    h: float
    n: int
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    left: int = 0
    right: int = 0

    @property
    def value(self) -> float:
        return self.g / self.h if self.h > 0 else 0.0


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)

    def leaves(self) -> int:
        return sum(node.feature < 0 for node in self.nodes)

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bins ends in."""
        feature = np.array([node.feature for node in self.nodes])
        limit = np.array([node.bin for node in self.nodes])
        left, right = np.array([node.left for node in self.nodes]), np.array([node.right for node in self.nodes])
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return at
            goes_left = bins[rows, np.maximum(feature[at], 0)] <= limit[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)

    def values_of(self, bins: np.ndarray) -> np.ndarray:
        return np.array([node.value for node in self.nodes])[self.nodes_of(bins)]


def bin_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class Rows:
    """The rows of a node that take no more room than its histogram."""

    bins: np.ndarray
    g: np.ndarray
    h: np.ndarray

    def where(self, kept: np.ndarray) -> Rows:
        return Rows(self.bins[kept], self.g[kept], self.h[kept])


class Places:
    """Where a feature's bins stand in a histogram."""

    def __init__(self, widths: Sequence[int]) -> None:
        self.widths = list(widths)
        self.starts = np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        self.size = int(self.starts[-1])

    def sums(self, rows: Rows, slot: np.ndarray, slots: int) -> np.ndarray:
        """Gradient, curvature and number of the rows by ``(slot, place)``."""
        place = (slot[:, None] * self.size + self.starts[:-1] + rows.bins).ravel()
        weights = (rows.g, rows.h, np.ones(len(rows.g)))
        flat = [np.bincount(place, np.repeat(w, len(self.widths)), slots * self.size) for w in weights]
        return np.stack(flat, -1).reshape(slots, self.size, 3)


def gather(
    steps: DataFrame, tree: Tree, wanted: Sequence[int], places: Places, partitions: int
) -> tuple[dict[int, np.ndarray], dict[int, Rows]]:
    """Histograms of the wanted nodes and, of those with at most as many rows as places, the rows.

    So much of a node comes to the driver and no more, whatever the number of rows. Every task sums its own rows;
    the sums of more than a few tasks are added up before they are collected.
    """
    small = [node for node in wanted if tree.nodes[node].n <= places.size]
    large = [node for node in wanted if tree.nodes[node].n > places.size]
    chosen = np.full(len(tree.nodes), -1)
    chosen[large] = np.arange(len(large))
    sent = np.full(len(tree.nodes), -1)
    sent[small] = np.arange(len(small))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(large), places.size, 3))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(bin_matrix(batch.column(0), len(places.widths)), *[batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2)])
            ends = tree.nodes_of(rows.bins)
            slot = chosen[ends]
            if (slot >= 0).any():
                sums += places.sums(rows.where(slot >= 0), slot[slot >= 0], len(large))
            out = sent[ends] >= 0
            if out.any():
                n, own = int(out.sum()), rows.where(out)
                yield _sum_batch(sent[ends][out], np.full(n, -1), own.g, own.h, np.ones(n), batch.column(0).filter(pa.array(out)))
        node, place = np.nonzero(sums[:, :, 2])
        if len(node):
            yield _sum_batch(node, place, *sums[node, place].T, pa.nulls(len(node), pa.list_(pa.int16())))

    if steps.columns != STEPS.names:
        steps = steps.select(*STEPS.names)
    sums = steps.mapInArrow(run, _SUMS)
    if partitions > FEW_PARTITIONS:
        rows, sums = sums.where("place < 0"), sums.where("place >= 0")
        sums = sums.groupBy("node", "place").agg(*[F.sum(name).alias(name) for name in ("g", "h", "n")])
        sums = sums.withColumn("bins", F.lit(None).cast("array<smallint>"))
        sums = sums.unionByName(rows) if small else sums
    table = sums.toArrow().combine_chunks()
    node, place, g, h, n = (table[name].to_numpy() for name in ("node", "place", "g", "h", "n"))
    summed = place >= 0
    out = np.zeros((len(large), places.size, 3))
    for k, values in enumerate((g, h, n)):
        np.add.at(out, (node[summed], place[summed], k), values[summed])
    known = {own: out[i] for i, own in enumerate(large)}
    local = {}
    for i, own in enumerate(small):
        mine = np.flatnonzero(~summed & (node == i))
        bins = table["bins"].take(pa.array(mine)).combine_chunks()
        local[own] = Rows(bin_matrix(bins, len(places.widths)), g[mine], h[mine])
        known[own] = places.sums(local[own], np.zeros(len(mine), np.int64), 1)[0]
    return known, local


def _sum_batch(node, place, g, h, n, bins: pa.Array) -> pa.RecordBatch:
    columns = [pa.array(x.astype(t)) for x, t in zip((node, place, g, h, n), ("i4", "i4", "f8", "f8", "i8"))]
    return pa.RecordBatch.from_arrays([*columns, bins], ["node", "place", "g", "h", "n", "bins"])


def best_split(histogram: np.ndarray, widths: Sequence[int], min_data_in_leaf: int) -> tuple[float, int, int, np.ndarray]:
    """Gain, feature and bin of the best split with the sums on its left; of equal gains the first one."""
    best = (0.0, -1, 0, np.zeros(3))
    start = 0
    for feature, width in enumerate(widths):
        left = np.cumsum(histogram[start : start + width], 0)
        start += width
        total, left = left[-1], left[:-1]
        right = total - left
        allowed = (left[:, 2] >= min_data_in_leaf) & (right[:, 2] >= min_data_in_leaf)
        allowed &= (left[:, 1] > 0) & (right[:, 1] > 0)
        if not allowed.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = left[:, 0] ** 2 / left[:, 1] + right[:, 0] ** 2 / right[:, 1] - total[0] ** 2 / total[1]
        gains = np.where(allowed, gains, -np.inf)
        at = int(gains.argmax())
        if gains[at] > best[0] + MIN_GAIN:
            best = (float(gains[at]), feature, at, left[at])
    return best


def grow(
    steps: DataFrame,
    widths: Sequence[int],
    num_leaves: int,
    min_data_in_leaf: int = 1,
    partitions: int | None = None,
    most: int | None = None,
) -> Tree:
    """A tree for ``steps(bins, gradient, curvature)``, of ``num_leaves`` leaves if so many splits gain anything.

    The tree that is looked into is a little larger than the one returned; the heap decides.
    ``partitions`` of ``steps`` and the ``most`` rows it can have are counted if they are not given.
    """
    places = Places(widths)
    partitions = steps.rdd.getNumPartitions() if partitions is None else partitions

    def find(tree: Tree, wanted: Sequence[int]) -> tuple[dict[int, np.ndarray], dict[int, Rows]]:
        return gather(steps, tree, wanted, places, partitions)

    root = Tree([Node(0.0, 0.0, steps.count() if most is None else most)])
    return _best_first(*find(root, [0]), find, places, num_leaves, min_data_in_leaf)


def grow_here(rows: Rows, widths: Sequence[int], num_leaves: int, min_data_in_leaf: int = 1) -> Tree:
    """The same tree for rows that are all at hand."""
    places = Places(widths)
    sums = places.sums(rows, np.zeros(len(rows.g), np.int64), 1)[0]
    return _best_first({0: sums}, {0: rows}, None, places, num_leaves, min_data_in_leaf)


def _best_first(
    known: dict[int, np.ndarray],
    local: dict[int, Rows],
    find: Callable[[Tree, Sequence[int]], tuple[dict[int, np.ndarray], dict[int, Rows]]] | None,
    places: Places,
    num_leaves: int,
    min_data_in_leaf: int,
) -> Tree:
    """A tree from the root's histogram in ``known``; ``find`` gathers nodes that do not lie below those in ``local``."""
    widths = places.widths
    g, h, n = known[0][: widths[0]].sum(0)
    looked = Tree([Node(float(g), float(h), int(n))])
    splits: dict[int, tuple[float, int, int, np.ndarray]] = {0: best_split(known[0], widths, min_data_in_leaf)}
    heap = [(-splits[0][0], 0)]
    taken: set[int] = set()  # split for good
    while heap and len(taken) < num_leaves - 1 and -heap[0][0] > MIN_GAIN:
        at = heap[0][1]
        if looked.nodes[at].feature < 0:
            reachable = [node for _, node in heapq.nsmallest(num_leaves - 1 - len(taken), heap)]
            leaves = [n for n in reachable if splits[n][1] >= 0 and looked.nodes[n].feature < 0]
            _look_into(find, looked, known, local, splits, leaves, places)
            for node in leaves:
                for child in (looked.nodes[node].left, looked.nodes[node].right):
                    splits[child] = best_split(known[child], widths, min_data_in_leaf)
        heapq.heappop(heap)
        taken.add(at)
        for child in (looked.nodes[at].left, looked.nodes[at].right):
            heapq.heappush(heap, (-splits[child][0], child))
    return _cut(looked, taken)


def _look_into(
    find: Callable | None,
    looked: Tree,
    known: dict[int, np.ndarray],
    local: dict[int, Rows],
    splits: dict,
    leaves: list[int],
    places: Places,
) -> None:
    """Split these leaves where it gains most and find their children's histograms, in one pass at most."""
    smaller, parent = _split_leaves(looked, splits, leaves)
    asked = []
    for few in smaller:
        at, _ = parent[few]
        if at in local:
            rows, node = local.pop(at), looked.nodes[at]
            goes_left = rows.bins[:, node.feature] <= node.bin
            for child, kept in ((node.left, goes_left), (node.right, ~goes_left)):
                local[child] = rows.where(kept)
            known[few] = places.sums(local[few], np.zeros(len(local[few].g), np.int64), 1)[0]
        else:
            asked.append(few)
    if asked:
        found, rows = find(looked, asked)
        known.update(found)
        local.update(rows)
    for few in smaller:
        at, many = parent[few]
        known[many] = known.pop(at) - known[few]


def _split_leaves(looked: Tree, splits: dict, leaves: list[int]) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Split these leaves where it gains most; the smaller child of each, and for it the parent and the other one."""
    smaller, parent = [], {}
    for at in leaves:
        gain, feature, place, left = splits[at]
        node = looked.nodes[at]
        node.feature, node.bin, node.gain = feature, place, gain
        node.left, node.right = len(looked.nodes), len(looked.nodes) + 1
        looked.nodes.append(Node(float(left[0]), float(left[1]), int(left[2])))
        looked.nodes.append(Node(node.g - float(left[0]), node.h - float(left[1]), node.n - int(left[2])))
        few, many = sorted((node.left, node.right), key=lambda child: looked.nodes[child].n)
        smaller.append(few)
        parent[few] = at, many
    return smaller, parent


def _cut(looked: Tree, taken: set[int]) -> Tree:
    """The part of the tree whose splits were taken, numbered from the root."""
    out = Tree()

    def copy(at: int) -> int:
        node, place = looked.nodes[at], len(out.nodes)
        out.nodes.append(Node(node.g, node.h, node.n))
        if at in taken:
            own = out.nodes[place]
            own.feature, own.bin, own.gain = node.feature, node.bin, node.gain
            own.left, own.right = copy(node.left), copy(node.right)
        return place

    copy(0)
    return out


def tree_rows(trees: Sequence[Tree]) -> pa.RecordBatch:
    """The nodes of the trees as rows of ``NODES``."""
    rows = [(i, at, *astuple(node)) for i, tree in enumerate(trees) for at, node in enumerate(tree.nodes)]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), to_arrow_schema(NODES).types)]
    return pa.RecordBatch.from_arrays(columns, NODES.names)


def trees_of(rows: pa.Table) -> list[Tree]:
    """The trees again."""
    trees: list[Tree] = []
    for row in rows.sort_by([("tree", "ascending"), ("node", "ascending")]).to_pylist():
        if row["node"] == 0:
            trees.append(Tree())
        trees[-1].nodes.append(Node(*[row[name] for name in NODES.names[2:]]))
    return trees


def raised_scores(score: np.ndarray, bins: np.ndarray, trees: Sequence[Tree], weight: float) -> np.ndarray:
    for tree in trees:
        score = score + weight * tree.values_of(bins)
    return score


def add_scores(rows: DataFrame, trees: Sequence[Tree], weight: float, features: int) -> DataFrame:
    """``rows`` with ``score`` raised by the weighted values of ``trees``; no shuffle."""
    schema = rows.schema
    names, at = schema.names, schema.names.index("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = batch.column(at).to_numpy(zero_copy_only=False)
            if len(score):
                score = raised_scores(score, bin_matrix(batch.column("bins"), features), trees, weight)
            columns = list(batch.columns)
            columns[at] = pa.array(score)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def spark_tree(tree: Tree, edges: Sequence[Sequence[float]], name: str):
    """The tree as a Spark ML regression model's JVM object, so that Spark ML scores, saves and loads it."""
    context = SparkSession.active().sparkContext
    jvm, gateway = context._jvm, context._gateway
    # Looked up once, as each part of a name is a call; the sums of all nodes go over in one.
    ml, double = jvm.org.apache.spark.ml.tree, jvm.double
    leaf, inner, split_at = ml.LeafNode, ml.InternalNode, ml.ContinuousSplit
    variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    order = range(len(tree.nodes) - 1, -1, -1)  # children come after their parent
    all_sums = np.array([(node.h, node.g, node.g * node.value) for node in tree.nodes], ">f8")[::-1]
    sent = jvm.java.nio.ByteBuffer.wrap(bytearray(all_sums.tobytes())).asDoubleBuffer()

    def next_stats(rows: int):
        sums = gateway.new_array(double, 3)
        sent.get(sums)
        return variance(sums, rows)

    built: dict[int, object] = {}
    for at in order:
        node = tree.nodes[at]
        stats = next_stats(node.n)
        if node.feature < 0:
            built[at] = leaf(float(node.value), 0.0, stats)
        else:
            split = split_at(node.feature, float(edges[node.feature][node.bin]))
            gain = float(node.gain / node.h)
            built[at] = inner(float(node.value), 0.0, gain, built[node.left], built[node.right], split, stats)
    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(name, built[0], len(edges))
