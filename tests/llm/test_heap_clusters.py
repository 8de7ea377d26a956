"""Heap-ordered k-means against plain rounds; what is popped against what can change."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quillrank.llm import heap_clusters, queries

SCHEMA = "vec_id long, embedding array<double>, cluster int, x string"


def plain(vectors, k, rounds, seed=2, scale=256):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of (vec_id, components)."""
    whole = [(i, [math.floor(scale * c) for c in x]) for i, x in vectors]
    name = {None: "null"}
    first = sorted((hashlib.sha256(f"{seed}:{name.get(i, i)}".encode()).hexdigest(), x) for i, x in whole)
    centroids = [x for _, x in first[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [near(x)[1] for _, x in whole]
        for j in range(len(centroids)):
            members = [x for (_, x), c in zip(whole, own) if c == j]
            if members:
                centroids[j] = [sum(column) // len(members) for column in zip(*members)]
    final = [(i, *near(x)[::-1]) for i, x in whole]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(d for _, _, d in final)
    return sorted(
        ((i, j, d, sum(e for _, c, e in final if c == j), total, digests[j]) for i, j, d in final), key=str
    )


def clustered(spark, rows, k=5, rounds=4, dimensions=4):
    table = spark.createDataFrame([(i, x, 1, "y") for i, x in rows], SCHEMA)
    vectors = heap_clusters.whole_vectors(table, "vec_id", "embedding", dimensions)
    assigned, heaps = heap_clusters.cluster(vectors, k, rounds, dimensions=dimensions)
    got = heap_clusters.with_inertia(assigned, heaps).withColumn("vec_id", F.col("vec_id").cast("long"))
    return sorted([tuple(row) for row in got.collect()], key=str), heaps


def random_rows(n, seed, dimensions=4):
    draw = random.Random(seed)
    centres = [[draw.uniform(-2, 2) for _ in range(dimensions)] for _ in range(6)]
    return [(i, [c + draw.gauss(0, 0.3) for c in draw.choice(centres)]) for i in range(n)]


def test_equals_plain_rounds(spark):
    for seed in (1, 2):
        rows = random_rows(150, seed)
        got, _ = clustered(spark, rows)
        assert got == plain(rows, 5, 4)


def test_ties_repeats_and_whole_grid(spark):
    """Equal distances everywhere: whole coordinates, repeated vectors and ids."""
    rows = [(i % 20, [float(i % 3), float(i % 2), 0.0, -1.0 / 256]) for i in range(60)] + [(None, [0.5] * 4)]
    got, _ = clustered(spark, rows, k=7)
    assert got == plain(rows, 7, 4)


def test_unusable_vectors_take_no_part(spark):
    rows = random_rows(12, 3)
    bad = [
        (100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 0.0, 0.0]),
        (104, [float("nan"), 0.0, 0.0, 0.0]), (105, [0.0, float("-inf"), 0.0, 0.0]),
    ]
    got, _ = clustered(spark, rows + bad, k=3)
    assert got == plain(rows, 3, 4)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = random_rows(2, 4)
    assert clustered(spark, rows, k=5)[0] == plain(rows, 5, 4)
    assert clustered(spark, rows[:1], k=5)[0] == plain(rows[:1], 5, 4)
    assert clustered(spark, [], k=5)[0] == []


def test_large_components_stay_exact():
    x = np.array([[3_000_000_01, -7], [1, 2]], np.int64)
    c = np.array([[3_000_000_00, 5], [-4, 2]], np.int64)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
    assert heap_clusters.squared_distances(x, c).tolist() == want


def test_only_expired_vectors_are_read_again(spark):
    rows = random_rows(400, 5)
    got, heaps = clustered(spark, rows, k=6, rounds=5)
    assert got == plain(rows, 6, 5)
    sizes = [run.count() for run, _ in heaps.runs]
    assert sizes[0] == 400 and sum(sizes[1:]) < 5 * 400  # plain rounds would compare all rows five times more
    assert heaps.members().count() == 400


def test_popping_is_a_range_that_the_scan_skips_by(spark):
    vectors = heap_clusters.whole_vectors(
        spark.createDataFrame([(i, x, 1, "y") for i, x in random_rows(50, 6)], SCHEMA), "vec_id", "embedding", 4
    )
    _, heaps = heap_clusters.cluster(vectors, 4, 2, dimensions=4)
    plan = heaps.runs[0][0].where(heaps._between(heaps.drift, None))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(key," in pushed and "EqualTo(cluster," in pushed


def test_registered_query(spark, tmp_path):
    rows = random_rows(80, 7, 64)
    table = spark.createDataFrame([(i, x, 1, "y") for i, x in rows], SCHEMA)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_heap_clusters(spark, str(tmp_path))
    assert dict(got.dtypes)["vec_id"] == "bigint"
    assert sorted([tuple(row) for row in got.collect()], key=str) == plain(rows, 40, 5)
