"""Ranking metrics, listings and failure analysis, for any number of queries in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators.grouping import HOT_ROWS, running_sums
from quillrank.schemas import require_columns

METRIC_DIGITS = 6


def gain(relevance: Column) -> Column:
    return F.pow(F.lit(2.0), relevance) - 1


def discount(rank: Column) -> Column:
    return 1 / F.log2(rank + 1)


def score_order(score: str, tie: str = "doc_id") -> list[Column]:
    """Score descending at six decimals, then ``tie``."""
    return [F.round(F.col(score), 6).desc(), F.col(tie)]


def ranked_listing(
    featured: DataFrame,
    score: str,
    query_key: str = "query_id",
    tie: str = "doc_id",
    threshold: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``rank`` within the query and ``hits``, the relevant rows up to that rank."""
    require_columns(featured, [query_key, score, tie, "relevance"])
    hit = (F.col("relevance") >= threshold).cast("int")
    sums = {"rank": F.lit(1), "hits": hit}
    return running_sums(featured, [query_key], score_order(score, tie), sums, hot_rows)


def precision_curve(featured: DataFrame, score: str, query_key: str = "query_id", **options) -> DataFrame:
    """:func:`ranked_listing` with ``precision``, the share of relevant rows up to each rank."""
    ranked = ranked_listing(featured, score, query_key, **options)
    return ranked.withColumn("precision", F.round(F.col("hits") / F.col("rank"), METRIC_DIGITS))


def ideal_dcg(levels: Column, k: int) -> Column:
    """IDCG@k from ``(relevance, rows)`` pairs sorted by relevance descending."""
    totals = [0.0]
    for rank in range(1, k + 1):
        totals.append(totals[-1] + 1 / math.log2(rank + 1))
    discounts = F.array(*[F.lit(total) for total in totals])

    def discount_up_to(rank: Column) -> Column:
        return F.get(discounts, F.least(rank, F.lit(k)).cast("int"))

    start = F.struct(F.lit(0).cast("long").alias("rank"), F.lit(0.0).alias("dcg"))

    def add(state: Column, level: Column) -> Column:
        end = state["rank"] + level["n"]
        span = discount_up_to(end) - discount_up_to(state["rank"])
        return F.struct(end.alias("rank"), (state["dcg"] + gain(level["relevance"]) * span).alias("dcg"))

    return F.aggregate(levels, start, add, lambda state: state["dcg"])


def evaluate_per_query(
    featured: DataFrame,
    score: str,
    k: int = 10,
    threshold: int = 1,
    query_key: str = "query_id",
    tie: str = "doc_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(query_key, ndcg, rr, ap)``: NDCG@k, reciprocal rank and average precision per query.

    Rows are summed per relevance grade first, so a query of any size reaches the last step as one
    row per grade; the ideal order needs only the number of rows of each grade.
    """
    ranked = ranked_listing(featured, score, query_key, tie, threshold, hot_rows)
    rank, relevant = F.col("rank"), F.col("relevance") >= threshold
    grades = ranked.groupBy(query_key, "relevance").agg(
        F.count("*").alias("n"),
        F.sum(F.when(rank <= k, gain(F.col("relevance")) * discount(rank)).otherwise(0.0)).alias("dcg"),
        F.min(F.when(relevant, rank)).alias("first_hit"),
        F.sum(F.when(relevant, F.col("hits") / rank).otherwise(0.0)).alias("precisions"),
        F.sum(relevant.cast("long")).alias("relevant"),
    )
    queries = grades.groupBy(query_key).agg(
        F.sum("dcg").alias("dcg"),
        F.min("first_hit").alias("first_hit"),
        F.sum("precisions").alias("precisions"),
        F.sum("relevant").alias("relevant"),
        F.sort_array(F.collect_list(F.struct("relevance", "n")), asc=False).alias("levels"),
    )

    def ratio(above: Column, below: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(above, below), F.lit(0.0)), METRIC_DIGITS)

    return queries.select(
        query_key,
        ratio(F.col("dcg"), ideal_dcg(F.col("levels"), k)).alias("ndcg"),
        ratio(F.lit(1.0), F.col("first_hit").cast("double")).alias("rr"),
        ratio(F.col("precisions"), F.col("relevant").cast("double")).alias("ap"),
    )


def evaluate(featured: DataFrame, score: str, k: int = 10, **options) -> DataFrame:
    """One row ``(ndcg, mrr, map, queries)``: means over queries, zeros if there are none."""
    per_query = evaluate_per_query(featured, score, k, **options)

    def mean(name: str) -> Column:
        return F.round(F.coalesce(F.avg(name), F.lit(0.0)), METRIC_DIGITS)

    return per_query.agg(
        mean("ndcg").alias("ndcg"), mean("rr").alias("mrr"), mean("ap").alias("map"), F.count("*").alias("queries")
    )


def ndcg_by_rank(
    featured: DataFrame,
    score: str,
    ranks: Sequence[int],
    query_key: str = "query_id",
    tie: str = "doc_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(k, ndcg)`` for several ranks: the rows are ranked once; means over queries as in :func:`evaluate`."""
    ranked = ranked_listing(featured, score, query_key, tie, hot_rows=hot_rows)
    ranks, rank = sorted(set(ranks)), F.col("rank")
    share = gain(F.col("relevance")) * discount(rank)
    grades = ranked.groupBy(query_key, "relevance").agg(
        F.count("*").alias("n"), *[F.sum(F.when(rank <= k, share).otherwise(0.0)).alias(f"dcg{k}") for k in ranks]
    )
    levels = F.sort_array(F.collect_list(F.struct("relevance", "n")), asc=False)
    queries = grades.groupBy(query_key).agg(*[F.sum(f"dcg{k}").alias(f"dcg{k}") for k in ranks], levels.alias("levels"))

    def mean(k: int) -> Column:
        ratio = F.coalesce(F.try_divide(F.col(f"dcg{k}"), ideal_dcg(F.col("levels"), k)), F.lit(0.0))
        return F.round(F.coalesce(F.avg(F.round(ratio, METRIC_DIGITS)), F.lit(0.0)), METRIC_DIGITS)

    means = queries.agg(*[mean(k).alias(f"ndcg{k}") for k in ranks])
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"ndcg{k}").alias("ndcg")) for k in ranks])
    return means.select(F.explode(each).alias("e")).select("e.k", "e.ndcg")


def evaluate_scores(featured: DataFrame, scores: Sequence[str], k: int = 10, **options) -> DataFrame:
    """:func:`evaluate` for several score columns: one row per ``score``."""
    parts = [
        evaluate(featured, score, k, **options).select(F.lit(score).alias("score"), "*") for score in scores
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def failures(featured: DataFrame, score: str, query_key: str = "query_id", tie: str = "doc_id") -> DataFrame:
    """Queries whose top document by score is not their top document by relevance.

    Both are found in one aggregation that keeps a single best row per task and query.
    """
    require_columns(featured, [query_key, "query", "document", "relevance", score, tie])
    row = F.struct("query", "document", F.col("relevance").cast("int").alias("relevance"))
    # min over (key descending, tie ascending) picks the first row of the order.
    by_score = F.min_by(row, F.struct(-F.round(F.col(score), 6), F.col(tie)))
    by_relevance = F.min_by(row, F.struct(-F.col("relevance"), F.col(tie)))
    return (
        featured.groupBy(query_key)
        .agg(by_score.alias("predicted"), by_relevance.alias("ideal"))
        .where(F.col("predicted.document") != F.col("ideal.document"))
        .select(
            query_key,
            F.col("predicted.query").alias("query"),
            F.col("predicted.document").alias("predicted_top_doc"),
            F.col("predicted.relevance").alias("predicted_top_rel"),
            F.col("ideal.document").alias("ideal_top_doc"),
            F.col("ideal.relevance").alias("ideal_top_rel"),
        )
    )


def label_distribution(judgements: DataFrame) -> DataFrame:
    """Rows per relevance grade."""
    return judgements.groupBy("relevance").agg(F.count("*").alias("n"))


def group_sizes(judgements: DataFrame, query_key: str = "query_id") -> DataFrame:
    """Judged rows per query."""
    return judgements.groupBy(query_key).agg(F.count("*").alias("n"))
