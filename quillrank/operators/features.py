"""The eight query-document features the ranker learns from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.functions.text import exact_match, overlap_count, overlap_ratio, tokens, with_clean_texts
from quillrank.operators.bm25 import with_group_score
from quillrank.operators.semantic import Encoder, semantic_cosine, with_text_similarity
from quillrank.operators.tfidf import tfidf_fit, with_tfidf_cosine
from quillrank.schemas import require_columns
from quillrank.session import materialise


def lexical_features(judgements: DataFrame) -> DataFrame:
    """Add the cleaned texts, lengths, overlap and exact match. No shuffle."""
    require_columns(judgements, ["query", "document"])
    query_words, doc_words = tokens(F.col("query_clean")), tokens(F.col("document_clean"))
    return (
        with_clean_texts(judgements)
        .withColumns({"_query_words": query_words, "_doc_words": doc_words})
        .withColumns({
            "query_len": F.size("_query_words").cast("long"),
            "doc_len": F.size("_doc_words").cast("long"),
            "overlap_count": overlap_count(F.col("_query_words"), F.col("_doc_words")).cast("long"),
            "exact_match": exact_match(F.col("query_clean"), F.col("document_clean")),
        })
        .withColumn("overlap_ratio", overlap_ratio(F.col("overlap_count"), F.col("query_len")))
        .drop("_query_words", "_doc_words")
    )


def build_features(
    judgements: DataFrame,
    terms: DataFrame | None = None,
    add_bm25: bool = True,
    add_semantic: bool = True,
    query_key: str = "query_id",
    doc_key: str | None = None,
    embeddings: tuple[DataFrame, DataFrame] | None = None,
    encoder: Encoder | None = None,
) -> DataFrame:
    """Keep the input columns and add the cleaned texts and the features.

    ``terms`` is a fitted TF-IDF table; without it the input is fitted on itself. BM25 is scored
    within each query's own rows, which is not the catalog-wide score of retrieval; pass
    ``add_bm25=False`` to keep that one. Similarity uses ``embeddings`` (query table, document
    table) if given, else ``encoder``, else hashed subwords.
    """
    require_columns(judgements, [query_key, "query", "document"])
    doc_key = doc_key or ("doc_id" if "doc_id" in judgements.columns else "document")
    # Stored once: every later step reads the cleaned texts several times.
    stored = materialise(lexical_features(judgements), "lexical-features")
    if terms is None:
        terms = materialise(tfidf_fit(stored), "tfidf-terms")
    featured = with_tfidf_cosine(stored, terms)
    if add_bm25:
        featured = with_group_score(featured, query_key, stored)
    if add_semantic and embeddings is not None:
        featured = semantic_cosine(featured, *embeddings, query_key, doc_key)
    elif add_semantic:
        featured = with_text_similarity(featured, encoder, stored)
    return featured
