"""Two-stage search: BM25 candidates, then features, model score and re-ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.operators.bm25 import Bm25Index, bm25_group_score, bm25_retrieve
from quillrank.operators.features import build_features
from quillrank.operators.grouping import top_k_per_group
from quillrank.operators.metrics import score_order
from quillrank.operators.ranker import LinearScorer, Ranker
from quillrank.operators.semantic import Encoder
from quillrank.schemas import require_columns
from quillrank.session import materialise


def rerank(
    candidates: DataFrame,
    ranker: Ranker | LinearScorer,
    terms: DataFrame,
    tie: str = "doc_id",
    embeddings: tuple[DataFrame, DataFrame] | None = None,
    encoder: Encoder | None = None,
) -> DataFrame:
    """Score top-k candidates with the model and rank them anew.

    Candidates keep their columns, the first-stage ``bm25_score`` among them. The lists must be
    bounded by a top-k; the similarity is computed only if the model reads it.
    """
    require_columns(candidates, ["query_id", "query", "document", "bm25_score", tie])
    featured = build_features(
        candidates.drop("rank"),
        terms,
        add_bm25=False,
        add_semantic="semantic_cosine_sim" in ranker.features,
        doc_key=tie,
        embeddings=embeddings,
        encoder=encoder,
    )
    kept = [name for name in candidates.columns if name != "rank"]
    scored = ranker.predict(featured).select(*kept, "model_score")
    return _ranked(scored, tie)


def _ranked(scored: DataFrame, tie: str) -> DataFrame:
    """Number bounded lists by model score."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*score_order("model_score", tie)))
    others = [name for name in scored.columns if name not in ("query_id", "query")]
    return scored.select("query_id", "query", rank.alias("rank"), *others)


def search(
    queries: DataFrame,
    index: Bm25Index,
    ranker: Ranker | LinearScorer,
    terms: DataFrame,
    retrieve_top_k: int = 10,
    **similarity,
) -> DataFrame:
    """Retrieve and re-rank for every row of ``queries(query_id, query)`` in one job."""
    candidates = materialise(bm25_retrieve(queries, index, retrieve_top_k), "candidates")
    return rerank(candidates, ranker, terms, **similarity)


def rank_documents(requests: DataFrame, ranker: Ranker | LinearScorer, terms: DataFrame, **similarity) -> DataFrame:
    """Rank the documents each request brings along: ``(query_id, query, documents)``.

    BM25 is scored within the request's own list, and the place in it breaks ties.
    """
    require_columns(requests, ["query_id", "query", "documents"])
    rows = requests.select("query_id", "query", F.posexplode("documents").alias("place", "document"))
    featured = build_features(
        rows,
        terms,
        add_semantic="semantic_cosine_sim" in ranker.features,
        doc_key="document",
        **similarity,
    )
    scored = ranker.predict(featured).select("query_id", "query", "place", "document", "model_score")
    return _ranked(scored, "place").drop("place")


def rank_record(
    nested: DataFrame, ranker: Ranker | LinearScorer, terms: DataFrame, top_k: int = 10, query: str | None = None
) -> DataFrame:
    """For every nested record, the ``top_k`` of its own passages by BM25, re-ranked.

    ``query`` replaces the records' own queries.
    """
    asked = F.col("query") if query is None else F.lit(query)
    rows = nested.select(
        "query_id", asked.alias("query"), F.posexplode("passages.passage_text").alias("place", "document")
    )
    order = [F.col("bm25_score").desc(), F.col("place")]
    candidates = top_k_per_group(bm25_group_score(rows), ["query_id"], order, top_k)
    reranked = rerank(_keyed(materialise(candidates, "record-candidates")), ranker, terms, tie="passage_id")
    return reranked.drop("passage_id").withColumnRenamed("place", "passage")


def _keyed(candidates: DataFrame) -> DataFrame:
    """A document key of its own for every passage; places repeat across records."""
    return candidates.withColumn(
        "passage_id", F.concat_ws(":", F.col("query_id"), F.format_string("%010d", F.col("place")))
    )
