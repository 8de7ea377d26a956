import random

import pytest
from brute import ranking_metrics
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillrank.operators.bm25 import bm25_group_score
from quillrank.operators.metrics import (
    evaluate,
    evaluate_per_query,
    failures,
    group_sizes,
    label_distribution,
    precision_curve,
    ranked_listing,
)

SCHEMA = "query_id STRING, query STRING, doc_id LONG, document STRING, relevance INT, score DOUBLE"


def table(spark, rows):
    return spark.createDataFrame([(q, q, d, f"text {d}", r, float(s)) for q, d, r, s in rows], SCHEMA)


def test_known_baseline(held_out):
    """Published metrics of BM25 on the held-out queries, to four digits."""
    scored = bm25_group_score(held_out)
    row = evaluate(scored, "bm25_score", 5).first()
    assert [round(row[name], 4) for name in ("ndcg", "mrr", "map")] == [0.8170, 0.8333, 0.7931]
    got = {r["query_id"]: (round(r["ndcg"], 4), r["rr"], round(r["ap"], 4)) for r in evaluate_per_query(scored, "bm25_score", 5).collect()}
    assert got == {
        "trail running shoes": (1.0, 1.0, 1.0),
        "student laptop": (0.5780, 0.5, 0.6792),
        "ergonomic chair": (0.8729, 1.0, 0.7),
    }


def random_rows(seed):
    rng = random.Random(seed)
    return [
        (q, d, rng.choice([0, 0, 1, 2, 3]) if q != "none" else 0, rng.choice([0, 0.5, 1, 1.5]))
        for q in ("a", "b", "none")
        for d in range(rng.randint(1, 40))
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("hot_rows", [1000, 5])
def test_metrics_equal_brute_force(spark, seed, hot_rows):
    rows = random_rows(seed)
    got = {
        r["query_id"]: (r["ndcg"], r["rr"], r["ap"])
        for r in evaluate_per_query(table(spark, rows), "score", 5, hot_rows=hot_rows).collect()
    }
    for query in ("a", "b", "none"):
        mine = [(s, d, r) for q, d, r, s in rows if q == query]
        assert got[query] == pytest.approx(ranking_metrics(mine, 5), abs=1e-6)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(-5, 5)), min_size=1, max_size=30))
def test_metric_bounds_and_perfect_order(spark, graded):
    rows = [("q", d, r, s) for d, (r, s) in enumerate(graded)]
    row = evaluate_per_query(table(spark, rows), "score", 10).first()
    assert all(0.0 <= row[name] <= 1.0 for name in ("ndcg", "rr", "ap"))
    perfect = evaluate_per_query(table(spark, [(q, d, r, r) for q, d, r, _ in rows]), "score", 10).first()
    assert perfect["ndcg"] == (1.0 if any(r for r, _ in graded) else 0.0)


def test_no_queries_gives_zeros(spark):
    assert tuple(evaluate(table(spark, []), "score").first()) == (0.0, 0.0, 0.0, 0)


def test_listing_and_curve(spark):
    df = table(spark, [("q", 1, 0, 2), ("q", 2, 3, 1), ("q", 3, 1, 1)])
    assert rows_of(ranked_listing(df, "score").select("doc_id", "rank", "hits"), "rank") == [
        (1, 1, 0), (2, 2, 1), (3, 3, 2),
    ]
    assert rows_of(precision_curve(df, "score").select("rank", "precision"), "rank") == [
        (1, 0.0), (2, 0.5), (3, 0.666667),
    ]


def test_failures(spark):
    rows = [("miss", 1, 0, 9), ("miss", 2, 3, 1), ("hit", 1, 3, 9), ("hit", 2, 0, 1), ("tie", 1, 3, 0), ("tie", 2, 3, 5)]
    got = rows_of(failures(table(spark, rows), "score").drop("query"), "query_id")
    # A tie in relevance is reported too: the documents differ.
    assert got == [("miss", "text 1", 0, "text 2", 3), ("tie", "text 2", 3, "text 1", 3)]


def test_counts(spark):
    df = table(spark, [("a", 1, 0, 1), ("a", 2, 3, 1), ("b", 1, 3, 1)])
    assert rows_of(group_sizes(df), "query_id") == [("a", 2), ("b", 1)]
    assert rows_of(label_distribution(df), "relevance") == [(0, 1), (3, 2)]
