"""Labelled training sets: label lookup, hard and random negatives, de-duplication, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.text import hash_number, seeded_hash
from quillrank.operators.bm25 import Bm25Index, bm25_top_ids
from quillrank.operators.grouping import hashed_order, skew_join, top_k_per_group
from quillrank.schemas import require_columns
from quillrank.session import materialise

POSITIVE, SEMI_RELEVANT, NEGATIVE = 3, 1, 0
HARD_NEGATIVES = 3
_CHUNK = 10_000


def labelled_ids(specs: DataFrame) -> DataFrame:
    """``(query_id, query, doc_id, relevance)`` from the id lists of the query specifications."""
    require_columns(specs, ["query_id", "query", "positives", "semi_relevant"], "specification columns")
    parts = [
        specs.select(
            "query_id",
            "query",
            F.explode(F.array_distinct(F.col(ids).cast("array<bigint>"))).alias("doc_id"),
            F.lit(grade).alias("relevance"),
        )
        for ids, grade in (("positives", POSITIVE), ("semi_relevant", SEMI_RELEVANT))
    ]
    return parts[0].unionByName(parts[1])


def label_lookup(specs: DataFrame, catalog: DataFrame) -> DataFrame:
    """The labelled ids with their documents; a document labelled for very many queries is split."""
    found = skew_join(labelled_ids(specs), catalog.select("doc_id", "document"), ["doc_id"], ["query_id"])
    return found.select("query_id", "query", "doc_id", "document", "relevance")


def unmatched_labels(specs: DataFrame, catalog: DataFrame) -> DataFrame:
    """The labelled ids the catalog does not have."""
    return labelled_ids(specs).join(catalog.select("doc_id"), "doc_id", "left_anti")


def hard_negative_ids(
    queries: DataFrame, labels: DataFrame, index: Bm25Index, top_k: int = 10, n: int = HARD_NEGATIVES
) -> DataFrame:
    """The first ``n`` of each query's ``top_k`` BM25 results that carry no label."""
    retrieved = bm25_top_ids(queries, index, top_k)
    unlabelled = retrieved.join(labels.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    return top_k_per_group(unlabelled, ["query_id"], [F.col("rank")], n, "place").select(
        "query_id", "doc_id"
    )


def shuffled_positions(catalog: DataFrame, seed: int = 42) -> DataFrame:
    """``(position, doc_id)``: the documents in ``md5(seed|doc_id)`` order, numbered from 0."""
    order = hashed_order(catalog.select("doc_id"), ["doc_id"], seed)
    return order.select((F.col("position") - 1).alias("position"), "doc_id")


def random_negative_ids(
    queries: DataFrame, used: DataFrame, catalog: DataFrame, n: int = 2, seed: int = 42
) -> DataFrame:
    """``min(n, available)`` documents per query outside ``used(query_id, doc_id)``, without repeats.

    All documents are shuffled once. A query starts at its own hashed place and walks on, around
    the end if need be, past its used documents. With ``u`` of them, ``u + n`` steps always hold
    ``n`` free ones, so no query is compared with the whole catalog.
    """
    positions = materialise(shuffled_positions(catalog, seed), "positions")
    n_docs = positions.count()
    counts = used.groupBy("query_id").agg(F.count("*").alias("n_used"))
    reach = F.least(F.coalesce("n_used", F.lit(0)) + n, F.lit(n_docs))
    steps = (
        queries.select("query_id")
        .join(counts, "query_id", "left")
        .select(
            "query_id",
            (hash_number(seeded_hash(seed, F.col("query_id"))) % n_docs).alias("start"),
            reach.alias("reach"),
        )
        .where(F.col("reach") > 0)
        # Two steps, so that no row ever holds more than a chunk of numbers.
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), ((F.col("reach") - 1) / _CHUNK).cast("long"))))
        .withColumn(
            "step",
            F.explode(
                F.sequence(
                    F.col("chunk") * _CHUNK,
                    F.least(F.col("chunk") * _CHUNK + _CHUNK, F.col("reach")) - 1,
                )
            ),
        )
        .select("query_id", "step", ((F.col("start") + F.col("step")) % n_docs).alias("position"))
    )
    free = (
        steps.join(positions, "position")
        .join(used.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    )
    return top_k_per_group(free, ["query_id"], [F.col("step")], n, "place").select("query_id", "doc_id")


def unused_docs(catalog: DataFrame, used: DataFrame) -> DataFrame:
    """The documents no query uses."""
    return catalog.join(used.select("doc_id"), "doc_id", "left_anti")


def dedup_max_relevance(judgements: DataFrame, query_key: str = "query_id") -> DataFrame:
    """One whole row per query and document: the one with the highest relevance.

    Among rows of equal relevance the greatest by the further columns stays.
    """
    rest = [c for c in judgements.columns if c not in (query_key, "doc_id", "relevance")]
    best = judgements.groupBy(query_key, "doc_id").agg(F.max(F.struct("relevance", *rest)).alias("best"))
    return best.select(query_key, "doc_id", "best.*").select(*judgements.columns)


def build_training_set(
    specs: DataFrame,
    catalog: DataFrame,
    index: Bm25Index,
    top_k: int = 10,
    n_random: int = 2,
    seed: int = 42,
) -> DataFrame:
    """``(query_id, query, doc_id, document, relevance)``: labels, hard and random negatives.

    Raises ``ValueError`` if a labelled id is not in the catalog. Only ids travel until the
    documents are joined at the end.
    """
    labels = materialise(labelled_ids(specs), "labels")
    absent = labels.join(catalog.select("doc_id"), "doc_id", "left_anti").limit(10).collect()
    if absent:
        raise ValueError(f"labelled doc_id not in the catalog: {sorted({row['doc_id'] for row in absent})}")
    queries = specs.select("query_id", "query")
    hard = materialise(hard_negative_ids(queries, labels, index, top_k), "hard-negatives")
    used = labels.select("query_id", "doc_id").unionByName(hard).distinct()
    random = random_negative_ids(queries, used, catalog, n_random, seed)
    ids = (
        labels.select("query_id", "doc_id", "relevance")
        .unionByName(hard.withColumn("relevance", F.lit(NEGATIVE)))
        .unionByName(random.withColumn("relevance", F.lit(NEGATIVE)))
    )
    best = materialise(dedup_max_relevance(ids), "training-ids")
    found = skew_join(best, catalog.select("doc_id", "document"), ["doc_id"], ["query_id"])
    return found.join(queries, "query_id").select("query_id", "query", "doc_id", "document", "relevance")


# --------------------------------------------------------------------------- splits and caps


def _up_to(key_hash: Column, cut: Column) -> Column:
    """Rows whose key comes no later than the cut; none if there is no cut."""
    return F.coalesce(key_hash <= cut, F.lit(False))


def split_by_query(
    judgements: DataFrame, test_size: float = 0.25, seed: int = 42, query_key: str = "query_id"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with whole queries on one side, ``ceil(test_size * queries)`` in test.

    Test queries are the first in ``md5(seed|key)`` order. Only the hash at the cut is looked up,
    so the rows are filtered in place and never shuffled, however large a query is.
    """
    keys = judgements.select(query_key).distinct()
    n_test = F.ceil(F.lit(float(test_size)) * F.count("*"))
    cut = (
        hashed_order(keys, [query_key], seed)
        .where(F.col("position") <= keys.agg(n_test).scalar())
        .agg(F.max("hash").alias("cut"))
        .scalar()
    )
    in_test = _up_to(seeded_hash(seed, F.col(query_key)), cut)
    return judgements.where(~in_test), judgements.where(in_test)


def split_by_keys(
    judgements: DataFrame, test_keys: DataFrame, query_key: str = "query_id"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with the given keys in test."""
    keys = test_keys.select(query_key).distinct()
    return (
        judgements.join(keys, query_key, "left_anti"),
        judgements.join(keys, query_key, "left_semi"),
    )


def cap_whole_queries(
    judgements: DataFrame, max_rows: int | None, seed: int = 42, query_key: str = "query_id"
) -> DataFrame:
    """Whole queries in ``md5(seed|key)`` order as long as they fit ``max_rows`` in total.

    A query with more rows than that never fits; it is left out and does not end the scan.
    """
    if max_rows is None:
        return judgements
    every = judgements.groupBy(query_key).agg(F.count("*").alias("n"))
    sizes = every.where(F.col("n") <= max_rows)
    cut = (
        hashed_order(sizes, [query_key], seed, F.col("n"))
        .where(F.col("position") <= max_rows)
        .agg(F.max("hash").alias("cut"))
        .scalar()
    )
    within = judgements.where(_up_to(seeded_hash(seed, F.col(query_key)), cut))
    too_large = every.where(F.col("n") > max_rows).select(query_key)  # at most rows / max_rows of them
    return within.join(too_large, query_key, "left_anti").select(*judgements.columns)
