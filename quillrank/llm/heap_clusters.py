"""Exact k-means over whole-number vectors, in which only vectors whose bounds expire are read again.

For every vector the gap between its distances to the second nearest and to its own centroid bounds how far
centroids may move before its cluster can change. Each cluster keeps a heap of these gaps. When centroids move, the
cluster's drift grows by its own move and the largest move of any other centroid; a vector enters with the key
``gap + drift`` and is popped once the drift reaches its key, then compared with all centroids and pushed again.

A heap is a set of stored runs ordered by ``(cluster, key)``: popping is a range of keys per cluster, a filter by
which the scan skips what has not expired, and the popped vectors are written as a new run. As drift only grows, an
entry of an older run is still in the heap exactly if its key exceeds the drift of its cluster at the last pop, so
nothing is rewritten or marked. A round thus reads and writes its expired vectors only, shuffles one sum a task and
cluster, and moves ``k`` centroids through the driver.

Defined results: vectors that are null, of another length or hold null or non-finite components take no part;
equal distances go to the smaller centroid number; a null id hashes as the text ``null``; rows that share an id are
vectors of their own; further columns are ignored; with fewer vectors than ``k`` each is a centroid; without any
the result is empty. Squared distances and sums of components must fit a long, else Spark reports an overflow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import map_batches
from quillrank.session import materialise

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: What rounding can take from a gap or drift of distances below 2**31, with room.
SLACK = 1e-5
#: Below this size of components all sums of products are exact in doubles.
_EXACT = 1 << 22
_RUN = "vec_id string, x array<long>, was int, cluster int, key double"


def whole_vectors(df: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: the id as text and ``floor(scale * component)`` of the vectors that take part."""
    x = F.col(vector)
    usable = F.coalesce(
        (F.size(x) == dimensions)
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
        F.lit(False),
    )
    floors = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return df.where(usable).select(F.col(key).cast("string").alias("vec_id"), floors.alias("x"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of seed and id: a bounded number, found by a top-k."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("vec_id", F.lit("null"))), 256)
    first = vectors.select(name.alias("name"), "x").orderBy("name", "x").limit(k)
    return [row["x"] for row in first.collect()]


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, as whole numbers."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT:
        x, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        difference = x - c
        out[:, j] = (difference * difference).sum(1)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and heap key of each vector; among equal distances the smaller number."""
    distances = squared_distances(x, centroids)
    cluster = distances.argmin(1)
    rows = np.arange(len(x))
    own = np.sqrt(distances[rows, cluster].astype(np.float64))
    others = distances.astype(np.float64)
    others[rows, cluster] = np.inf
    gap = np.sqrt(others.min(1)) - own
    return cluster, gap + drift[cluster]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


@dataclass
class Heaps:
    """Runs with the drift up to which each has been popped (None: not yet), and the drift of every cluster."""

    centroids: np.ndarray
    drift: np.ndarray
    runs: list[tuple[DataFrame, np.ndarray | None]] = field(default_factory=list)

    def moved(self, centroids: np.ndarray) -> None:
        """Take up new centroids: every cluster's drift grows by its own move and the largest other one."""
        steps = [math.sqrt(sum(int(d) ** 2 for d in row)) for row in centroids - self.centroids]
        if len(steps) > 1:
            ordered = sorted(steps)
            largest = [ordered[-2] if step == ordered[-1] else ordered[-1] for step in steps]
            self.drift = self.drift + np.array(steps) + np.array(largest)
        self.centroids = centroids

    def _between(self, low: np.ndarray | None, high: np.ndarray | None) -> Column:
        """Entries whose key lies above ``low`` and not above ``high``, as one range a cluster for the scan to skip by."""
        out = F.lit(False)
        for j in range(len(self.drift)):
            inside = F.col("cluster") == j
            if low is not None:
                inside &= F.col("key") > float(low[j] + SLACK)
            if high is not None:
                inside &= F.col("key") <= float(high[j] + SLACK)
            out |= inside
        return out

    def push(self, vectors: DataFrame) -> DataFrame:
        """Compare ``(vec_id, x, was)`` with all centroids and store them as a run."""
        centroids, drift = self.centroids, self.drift

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cluster, key = nearest(_matrix(batch.column(1), centroids.shape[1]), centroids, drift)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(cluster, pa.int32()), pa.array(key, pa.float64())],
                        ["vec_id", "x", "was", "cluster", "key"],
                    )

        pushed = map_batches(vectors, run, _RUN).sortWithinPartitions("cluster", "key")
        stored = materialise(pushed, "cluster-run")
        self.runs.append((stored, None))
        return stored

    def pop(self) -> DataFrame:
        """``(vec_id, x, was)`` of the vectors whose keys the drift has reached since the last pop."""
        expired = [table.where(self._between(low, self.drift)) for table, low in self.runs]
        self.runs = [(table, self.drift) for table, _ in self.runs]
        out = expired[0]
        for part in expired[1:]:
            out = out.unionByName(part)
        return out.select("vec_id", "x", F.col("cluster").alias("was"))

    def members(self) -> DataFrame:
        """All entries in the heaps: every vector once."""
        live = [table if low is None else table.where(self._between(low, None)) for table, low in self.runs]
        out = live[0]
        for part in live[1:]:
            out = out.unionByName(part)
        return out


def _sums(rows: DataFrame, cluster: str, dimensions: int) -> dict[int, tuple[int, list[int]]]:
    """Number and component sums of the vectors of each cluster: one row a task and cluster is shuffled."""
    totals = rows.groupBy(F.col(cluster).alias("c")).agg(
        F.count("*").alias("n"), F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(dimensions)]).alias("sums")
    )
    return {row["c"]: (row["n"], row["sums"]) for row in totals.collect()}


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS
) -> tuple[DataFrame, Heaps]:
    """Assign, then ``rounds`` times move the centroids and assign again, for ``vectors(vec_id, x)``.

    Gives ``(vec_id, x, cluster)`` with the last centroids, and the heaps they come from.
    """
    first = first_centroids(vectors, k, seed)
    heaps = Heaps(np.array(first, np.int64).reshape(-1, dimensions), np.zeros(len(first)))
    if not first:
        return vectors.withColumn("cluster", F.lit(None).cast("int")).limit(0), heaps
    run = heaps.push(vectors.withColumn("was", F.lit(None).cast("int")))
    totals = {j: [0, [0] * dimensions] for j in range(len(first))}
    for _ in range(rounds):
        changed = run.where(~F.col("cluster").eqNullSafe(F.col("was")))
        for sign, side in ((1, "cluster"), (-1, "was")):
            for j, (n, sums) in _sums(changed.where(F.col(side).isNotNull()), side, dimensions).items():
                totals[j][0] += sign * n
                totals[j][1] = [a + sign * b for a, b in zip(totals[j][1], sums)]
        moved = [
            [total // n for total in sums] if n else heaps.centroids[j].tolist() for j, (n, sums) in totals.items()
        ]
        heaps.moved(np.array(moved, np.int64))
        run = heaps.push(heaps.pop())
    return heaps.members().select("vec_id", "x", "cluster"), heaps


def with_inertia(assigned: DataFrame, heaps: Heaps) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of :func:`cluster`'s vectors."""
    spark, centroids = assigned.sparkSession, heaps.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, own = _matrix(batch.column(1), centroids.shape[1]), batch.column(2).to_numpy()
                difference = x - centroids[own]
                distance = (difference * difference).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
                )

    measured = materialise(map_batches(assigned, run, "vec_id string, cluster int, distance long"), "cluster-distances")
    names = [(j, sha256(",".join(map(str, row)).encode()).hexdigest()) for j, row in enumerate(centroids.tolist())]
    totals = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = totals.withColumn("inertia", measured.agg(F.sum("distance")).scalar())
    totals = totals.join(F.broadcast(spark.createDataFrame(names, "cluster int, centroid_sha256 string")), "cluster")
    return measured.join(F.broadcast(totals), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
