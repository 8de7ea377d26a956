import hashlib

import pytest
from brute import tfidf_cosines
from pyspark.sql import functions as F

from quillrank.functions.text import with_clean_texts
from quillrank.operators.features import build_features
from quillrank.operators.semantic import semantic_cosine, text_embed, with_text_similarity
from quillrank.operators.tfidf import tfidf_cosine, tfidf_fit, weighted_terms
from quillrank.schemas import ALL_FEATURES, require_columns


def test_tfidf_cosine_equals_brute_force(held_out):
    rows = held_out.collect()
    expected = tfidf_cosines([(r["query"], r["document"]) for r in rows])
    got = {(r["query_id"], r["doc_id"]): r["tfidf_cosine_sim"] for r in tfidf_cosine(held_out).collect()}
    assert [got[r["query_id"], r["doc_id"]] for r in rows] == pytest.approx(expected, abs=1e-6)


def test_tfidf_edge_cases(spark):
    rows = [("q", "a 5 red", 1, "red c 5"), ("q", "a 5 red", 2, ""), ("r", "", 1, "red"), ("s", "blue", 1, "green")]
    df = spark.createDataFrame(rows, "query_id STRING, query STRING, doc_id LONG, document STRING")
    tokens = {row["token"] for row in tfidf_fit(df).collect()}
    assert tokens == {"red", "blue", "green"}
    got = {(r["query_id"], r["doc_id"]): r["tfidf_cosine_sim"] for r in tfidf_cosine(df).collect()}
    assert got == {("q", 1): 1.0, ("q", 2): 0.0, ("r", 1): 0.0, ("s", 1): 0.0}


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    rows = [("q", "red chair", 1, "red chair"), ("q", "red chair", 1, "red table lamp"), ("q", "blue", 1, "red chair")]
    df = spark.createDataFrame(rows, "query_id STRING, query STRING, doc_id LONG, document STRING")
    got = {(r["query"], r["document"]): r["tfidf_cosine_sim"] for r in tfidf_cosine(df).collect()}
    unique = df.withColumn("query_id", F.col("query")).withColumn("doc_id", F.xxhash64("document"))
    assert got == {(r["query"], r["document"]): r["tfidf_cosine_sim"] for r in tfidf_cosine(unique).collect()}
    assert got["red chair", "red chair"] == 1.0 and got["blue", "red chair"] == 0.0
    assert 0.0 < got["red chair", "red table lamp"] < 1.0


def test_unseen_tokens_are_dropped(spark, held_out):
    terms = tfidf_fit(held_out).cache()
    row = [("q", "laptop unseen", 1, "laptop other")]
    df = spark.createDataFrame(row, "query_id STRING, query STRING, doc_id LONG, document STRING")
    assert tfidf_cosine(df, terms).first()["tfidf_cosine_sim"] == 1.0


def test_build_features_columns_and_flags(held_out):
    featured = build_features(held_out)
    assert set(held_out.columns) | {"query_clean", "document_clean"} | set(ALL_FEATURES) == set(featured.columns)
    assert featured.count() == held_out.count()
    lean = build_features(held_out, add_bm25=False, add_semantic=False)
    assert not {"bm25_score", "semantic_cosine_sim"} & set(lean.columns)


def test_build_features_without_document_ids(held_out):
    expected = {(r["query"], r["document"]): r["tfidf_cosine_sim"] for r in build_features(held_out).collect()}
    by_text = build_features(held_out.drop("doc_id"))
    assert {(r["query"], r["document"]): r["tfidf_cosine_sim"] for r in by_text.collect()} == expected


def test_text_embed_unit_vectors(spark):
    rows = [(1, "student laptop"), (2, "students laptops"), (3, "wooden table"), (4, "")]
    df = text_embed(spark.createDataFrame(rows, "id LONG, text STRING"), "text")
    vectors = {r["id"]: r["vector"] for r in df.collect()}
    assert all(sum(x * x for x in vectors[i]) == pytest.approx(1.0) for i in (1, 2, 3))
    assert sum(vectors[4]) == 0.0

    def dot(a, b):
        return sum(x * y for x, y in zip(vectors[a], vectors[b]))

    assert dot(1, 2) > 0.5 > dot(1, 3)


def test_same_text_has_the_same_vector_in_every_call(spark):
    df = spark.createDataFrame([(1, "Student laptop", "student laptop!"), (2, "laptop", "chair")], "id LONG, query STRING, document STRING")
    first, second = (
        {r["id"]: r["vector"] for r in text_embed(df, column).collect()} for column in ("query", "document")
    )
    assert first[1] == second[1]
    # fixed by MD5, so another session gives the same
    places = {int(hashlib.md5(piece.encode()).hexdigest()[:15], 16) % 256 for piece in ("laptop", "5:lapto", "4:lapt")}
    assert {i for i, x in enumerate(first[2]) if x} == places
    for _ in range(2):
        got = {r["id"]: r["semantic_cosine_sim"] for r in with_text_similarity(with_clean_texts(df)).collect()}
        assert got[1] == 1.0 and got[2] < 0.5


def test_semantic_cosine_from_tables(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "query_id LONG, doc_id LONG")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id LONG, vector ARRAY<FLOAT>")
    docs = spark.createDataFrame([(10, [3.0, 4.0]), (11, [0.0, 0.0])], "doc_id LONG, vector ARRAY<FLOAT>")
    got = {tuple(r[:2]): r[2] for r in semantic_cosine(pairs, queries, docs).collect()}
    assert got == {(1, 10): 0.6, (1, 11): 0.0, (2, 10): 0.0}


def test_user_encoder_sees_each_text_once(spark, held_out):
    def encode(batches):
        for batch in batches:
            yield batch.assign(vector=[[float(len(text)), 1.0] for text in batch["text"]])

    featured = build_features(held_out, encoder=encode)
    row = featured.where("query_id = 'student laptop' and doc_id = 3").first()
    a, b = len("student laptop"), len("lenovo legion gaming laptop")
    expected = (a * b + 1) / ((a * a + 1) ** 0.5 * (b * b + 1) ** 0.5)
    assert row["semantic_cosine_sim"] == pytest.approx(expected, abs=1e-6)


def test_missing_columns_are_named(held_out):
    with pytest.raises(ValueError, match=r"\['nope'\]"):
        require_columns(held_out, ["query", "nope"], "features")


def test_tables_that_grow_with_the_input_are_not_sent_through_the_driver(spark, held_out):
    """The vocabulary and the vectors of texts, however small their files, are joined by a shuffle."""
    cleaned = with_clean_texts(held_out)
    terms = tfidf_fit(held_out)
    texts = cleaned.select("doc_id", "document_clean").distinct()
    for joined in (weighted_terms(texts, "doc_id", "document_clean", terms), with_text_similarity(cleaned)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
