import hashlib
import math
import random

import pytest
from brute import bm25, top
from conftest import CATALOG, rows_of
from pyspark.sql import functions as F

from quillrank.operators import labels
from quillrank.operators.judgements import build_judgements, nest_candidates
from quillrank.schemas import NESTED_RECORDS, QUERY_SPECS

SPECS = [
    (1, "gaming laptop", [1, 2, 3], [4, 17, 18]),
    (2, "socks", [20], [13, 14, 15, 20]),
    (3, "laptop charger", [19], []),
]


@pytest.fixture(scope="module")
def specs(spark):
    return spark.createDataFrame(SPECS, QUERY_SPECS)


def test_label_lookup(specs, catalog):
    got = rows_of(labels.label_lookup(specs, catalog).where("query_id = 3"), "doc_id")
    assert got == [(3, "laptop charger", 19, "usb c laptop charger", 3)]


def test_training_set(specs, catalog, catalog_index):
    df = labels.build_training_set(specs, catalog, catalog_index)
    assert df.columns == ["query_id", "query", "doc_id", "document", "relevance"]
    got = {}
    for row in df.collect():
        got.setdefault(row["query_id"], {})[row["doc_id"]] = row["relevance"]
    texts = [text for _, text, _ in CATALOG]
    ids = [doc_id for doc_id, _, _ in CATALOG]
    for query_id, query, positives, semi in SPECS:
        marked = set(positives) | set(semi)
        retrieved = [doc_id for doc_id, _ in top(bm25(query, texts), ids, 10)]
        hard = [doc_id for doc_id in retrieved if doc_id not in marked][:3]
        graded = got[query_id]
        assert all(graded[d] == 3 for d in positives)
        assert all(graded[d] == 1 for d in set(semi) - set(positives))
        assert all(graded[d] == 0 for d in hard)
        rest = set(graded) - marked - set(hard)
        assert len(rest) == 2 and all(graded[d] == 0 for d in rest)


def test_unknown_label_raises(spark, catalog, catalog_index):
    bad = spark.createDataFrame([(1, "x", [999], [])], QUERY_SPECS)
    assert rows_of(labels.unmatched_labels(bad, catalog).select("doc_id"), "doc_id") == [(999,)]
    with pytest.raises(ValueError, match="999"):
        labels.build_training_set(bad, catalog, catalog_index)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_random_negatives_are_complete(spark, n):
    """Exactly min(n, available) unused documents, also where nearly all are used."""
    rng = random.Random(5)
    catalog = spark.range(1, 13).withColumnRenamed("id", "doc_id")
    used = {q: set(rng.sample(range(1, 13), count)) for q, count in enumerate([0, 1, 6, 10, 11, 12])}
    pairs = [(q, d) for q, docs in used.items() for d in docs]
    queries = spark.createDataFrame([(q,) for q in used], "query_id LONG")
    table = spark.createDataFrame(pairs, "query_id LONG, doc_id LONG")
    drawn = labels.random_negative_ids(queries, table, catalog, n)
    got = {q: [] for q in used}
    for row in drawn.collect():
        got[row["query_id"]].append(row["doc_id"])
    for q, docs in got.items():
        assert len(docs) == len(set(docs)) == min(n, 12 - len(used[q]))
        assert not set(docs) & used[q]
    again = labels.random_negative_ids(queries, table.repartition(3), catalog.repartition(5), n)
    assert rows_of(drawn, "query_id", "doc_id") == rows_of(again, "query_id", "doc_id")


def test_dedup_keeps_highest_relevance(spark):
    df = spark.createDataFrame(
        [("q", "q", 1, "d", 0), ("q", "q", 1, "d", 3), ("q", "q", 2, "e", 1)],
        "query_id STRING, query STRING, doc_id LONG, document STRING, relevance INT",
    )
    got = labels.dedup_max_relevance(df)
    assert got.columns == df.columns
    assert rows_of(got, "doc_id") == [("q", "q", 1, "d", 3), ("q", "q", 2, "e", 1)]


def test_dedup_keeps_the_whole_best_row(spark):
    rows = [(1, 1, 0, "of zero", None), (1, 1, 3, "of three", 5), (1, 1, 3, "of three", 4), (1, 2, None, "z", 1)]
    df = spark.createDataFrame(rows, "query_id LONG, doc_id LONG, relevance INT, note STRING, n INT")
    assert rows_of(labels.dedup_max_relevance(df), "doc_id") == [(1, 1, 3, "of three", 5), (1, 2, None, "z", 1)]


def test_unused_docs(spark, catalog):
    used = spark.createDataFrame([(1, d) for d in range(3, 21)], "query_id LONG, doc_id LONG")
    assert rows_of(labels.unused_docs(catalog, used).select("doc_id"), "doc_id") == [(1,), (2,)]


@pytest.mark.parametrize(("queries", "share"), [(12, 0.25), (7, 0.2), (40, 0.5), (1, 0.25), (5, 0.0)])
def test_split_keeps_queries_whole(spark, queries, share):
    rows = [(q, d) for q in range(queries) for d in range(1 + q % 4)]
    df = spark.createDataFrame(rows, "query_id LONG, doc_id LONG")
    train, test = labels.split_by_query(df, share)
    in_train = {r[0] for r in train.select("query_id").distinct().collect()}
    in_test = {r[0] for r in test.select("query_id").distinct().collect()}
    assert not in_train & in_test and len(in_train | in_test) == queries
    assert len(in_test) == math.ceil(share * queries)
    assert train.count() + test.count() == len(rows)
    assert "Exchange hash" not in train._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_split_by_keys(spark, held_out):
    keys = spark.createDataFrame([("student laptop",)], "query_id STRING")
    train, test = labels.split_by_keys(held_out, keys)
    assert (train.count(), test.count()) == (16, 9)


@pytest.mark.parametrize("cap", [0, 1, 10, 37, 1000, None])
def test_cap_keeps_whole_queries_in_hash_order(spark, cap):
    sizes = {q: 1 + q % 5 for q in range(20)}
    df = spark.createDataFrame([(q, d) for q, n in sizes.items() for d in range(n)], "query_id LONG, d INT")
    kept, total = set(), 0
    for q in sorted(sizes, key=lambda q: hashlib.md5(f"42|{q}".encode()).hexdigest()):
        if cap is not None and sizes[q] > cap:
            continue  # can never fit
        total += sizes[q]
        if cap is not None and total > cap:
            break
        kept.add(q)
    got = labels.cap_whole_queries(df, cap).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {q: sizes[q] for q in kept}


def test_one_large_query_does_not_empty_the_scan(spark):
    df = spark.createDataFrame([(1, d) for d in range(10)] + [(q, 0) for q in range(2, 5)], "query_id LONG, d INT")
    assert labels.cap_whole_queries(df, 5).count() == 3
    alone = df.where("query_id = 1")
    assert labels.cap_whole_queries(alone, 5).count() == 0 and labels.cap_whole_queries(alone, 10).count() == 10


NESTED = [
    (1, "a", (["n1", "p1", "n2", "n3", "n4", "n5", "p2"], [0, 1, 0, 0, 0, 0, 1])),
    (2, "none selected", (["x", "y"], [0, 0])),
    (3, "uneven", (["p", "n", "surplus"], [1, 0])),
    (4, "flags surplus", (["p"], [1, 0, 0])),
    (5, "nothing", ([], [])),
    (6, "null", None),
]


def test_build_judgements(spark):
    nested = spark.createDataFrame(NESTED, NESTED_RECORDS)
    got = {}
    for row in build_judgements(nested).collect():
        got.setdefault(row["query_id"], []).append((row["document"], row["relevance"]))
    assert got == {
        1: [("p1", 3), ("p2", 3), ("n1", 0), ("n2", 0), ("n3", 0), ("n4", 0)],
        3: [("p", 3), ("n", 0)],
        4: [("p", 3)],
    }


def test_record_cap_counts_records_with_a_positive(spark):
    nested = spark.createDataFrame(NESTED, NESTED_RECORDS)
    got = build_judgements(nested, max_records=2).select("query_id").distinct()
    assert rows_of(got, "query_id") == [(1,), (3,)]
    assert build_judgements(nested, max_records=0).count() == 0


def test_nest_candidates_round_trip(spark):
    rows = [(1, "q", 2, "b", 3), (1, "q", 1, "a", 0)]
    df = spark.createDataFrame(rows, "query_id LONG, query STRING, rank INT, document STRING, relevance INT")
    record = nest_candidates(df).first()
    assert record["passages"]["passage_text"] == ["a", "b"] and record["passages"]["is_selected"] == [0, 1]
    assert rows_of(build_judgements(nest_candidates(df)).select("document", F.col("relevance")), "document") == [
        ("a", 0), ("b", 3),
    ]
