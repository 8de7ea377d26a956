"""The neighbour graph and its search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.llm import nn_descent, queries

SCHEMA = "vec_id long, embedding array<float>, node long, d double"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, 0.0) for i, x in rows], SCHEMA)


def brute(rows, asked, top_k=10):
    """(query_id, rank, vec_id, score) over rows of (vec_id, components); a query leaves its own row out."""
    out = []
    x = np.array([np.float32(v) for _, v in rows], np.float64)
    for at in asked:
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        order = sorted((d[j], rows[j][0]) for j in range(len(rows)) if j != at)
        out += [(rows[at][0], r, i, s) for r, (s, i) in enumerate(order[:top_k], 1)]
    return sorted(out)


def found(spark, rows, asked_ids, top_k=10, **options):
    data = table(spark, rows)
    graph = nn_descent.build(data, most=top_k + 1, **options)
    got = nn_descent.search(graph, data.where(F.col("vec_id").isin(asked_ids)), top_k=top_k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(row) for row in got.collect())


def random_rows(n, dimensions, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, dimensions))
    return [(i, (centres[i % 8] + 0.6 * draw.normal(size=dimensions)).tolist()) for i in range(n)]


def test_recall_against_brute_force(spark):
    rows = random_rows(3000, 32, 1)
    asked = list(range(0, 3000, 50))
    got, want = found(spark, rows, asked), brute(rows, asked)
    assert [row[:2] for row in got] == [row[:2] for row in want]
    known = {(q, v): s for q, _, v, s in brute(rows, asked, 3000)}
    assert all(known[q, v] == s for q, _, v, s in got)  # the measure itself, exactly
    assert all(a[3] <= b[3] for a, b in zip(got, got[1:]) if a[0] == b[0])
    hits = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want})
    assert hits >= 0.95 * len(want)


def test_copies_ties_and_unusable_vectors(spark):
    """A third of all rows are one vector; a grid gives ties; what cannot be measured takes no part."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 120, 2)]
    rows += [(200 + i, [float(i % 5), float(i // 5), 0.0]) for i in range(25)]
    rows += [(300, [-0.0, 1.0, 0.0]), (301, [1.0, 2.0, 3.0])]
    asked = [0, 40, 118, 201, 212, 300]
    bad = [
        (400, None), (401, []), (402, [0.0, 0.0, 0.0]), (403, [1.0, None, 1.0]), (404, [float("nan"), 1.0, 1.0]),
        (405, [float("inf"), 1.0, 1.0]), (406, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
    ]
    usable = [row for row in rows if any(row[1])]  # the grid holds one zero vector
    want = brute(usable, [next(j for j, row in enumerate(usable) if row[0] == i) for i in asked])
    assert found(spark, rows + bad, [*asked, 400, 401, 402, 403, 404, 405, 406]) == want


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_fewer_candidates_than_asked_for(spark, n):
    rows = random_rows(n, 4, 2)
    assert found(spark, rows, list(range(n))) == brute(rows, range(n))


def test_queries_outside_the_graph_and_repeated_ones(spark):
    rows = random_rows(400, 8, 3)
    graph = nn_descent.build(table(spark, rows))
    new = [(1000, rows[5][1]), (1001, (np.array(rows[17][1]) + 0.01).tolist()), (1001, (np.array(rows[17][1]) + 0.01).tolist())]
    got = nn_descent.search(graph, table(spark, [*new, (1002, [1.0])]), top_k=3)
    got = sorted(tuple(row) for row in got.collect())
    assert got == sorted({*brute([*rows, new[0]], [400], 3), *brute([*rows, new[1]], [400], 3)})
    with pytest.raises(ValueError, match="top_k"):
        nn_descent.search(graph, table(spark, new), top_k=11)


def test_rows_that_repeat_an_id_are_candidates(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    got = found(spark, rows, [1, 2], top_k=5)
    near = 2**0.5
    assert got == [(1, 1, 1, 0.0), (1, 2, 2, near), (2, 1, 1, near), (2, 2, 1, near)]


def test_registered_query(spark, tmp_path):
    rows = random_rows(301, 16, 4)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(row) for row in queries.op11_nn_descent(spark, str(tmp_path)).collect())
    assert got == brute(rows, [0, 100, 200, 300])
