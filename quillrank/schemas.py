"""Explicit schemas of the tables this library reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CATALOG = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("document", T.StringType()),
    T.StructField("category", T.StringType()),
])

JUDGEMENTS = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("document", T.StringType()),
    T.StructField("relevance", T.IntegerType()),
])

JUDGEMENTS_WITHOUT_ID = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("document", T.StringType()),
    T.StructField("relevance", T.IntegerType()),
])

QUERY_SPECS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("positives", T.ArrayType(T.LongType())),
    T.StructField("semi_relevant", T.ArrayType(T.LongType())),
])

NESTED_RECORDS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("passages", T.StructType([
        T.StructField("passage_text", T.ArrayType(T.StringType())),
        T.StructField("is_selected", T.ArrayType(T.IntegerType())),
    ])),
])

JUDGEMENT_SHARD = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("document", T.StringType()),
    T.StructField("relevance", T.IntegerType()),
])

EXPERIMENT_LOG = T.StructType([
    T.StructField("experiment_name", T.StringType()),
    T.StructField("features", T.StringType()),
    T.StructField("ndcg@5", T.DoubleType()),
    T.StructField("mrr", T.DoubleType()),
    T.StructField("map", T.DoubleType()),
    T.StructField("notes", T.StringType()),
])

QUERIES = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
])

LEXICAL_FEATURES = [
    "query_len",
    "doc_len",
    "overlap_count",
    "overlap_ratio",
    "exact_match",
    "tfidf_cosine_sim",
    "bm25_score",
]
ALL_FEATURES = LEXICAL_FEATURES + ["semantic_cosine_sim"]


def require_columns(df: DataFrame, names: Iterable[str], what: str = "columns") -> None:
    """Raise ``ValueError`` naming the absent columns, before any job runs."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"Missing {what}: {missing}")
