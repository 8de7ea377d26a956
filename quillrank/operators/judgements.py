"""Judgements from nested passage records; the same plan runs on a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators.grouping import running_sums
from quillrank.operators.labels import NEGATIVE, POSITIVE

MAX_NEGATIVES = 4


def _flagged(flag: int) -> Column:
    """The passages with the given selection flag, in order; surplus flags or passages are ignored."""
    passages, flags = F.col("passages.passage_text"), F.col("passages.is_selected")
    shared = F.least(F.size(passages), F.size(flags))
    pairs = F.arrays_zip(
        F.slice(passages, 1, shared).alias("text"), F.slice(flags, 1, shared).alias("flag")
    )
    return F.transform(F.filter(pairs, lambda pair: pair["flag"] == flag), lambda pair: pair["text"])


def _labelled(texts: Column, relevance: int) -> Column:
    return F.transform(
        texts, lambda text: F.struct(text.alias("document"), F.lit(relevance).alias("relevance"))
    )


def build_judgements(
    nested: DataFrame, max_negatives: int = MAX_NEGATIVES, max_records: int | None = None
) -> DataFrame:
    """``(query_id, query, document, relevance)``: all selected passages, then the first others.

    Records without a selected passage are dropped. ``max_records`` keeps exactly that many of the rest (all, if
    fewer), in ``query_id`` order; it needs the whole input and so works on a batch only. Stateless otherwise.
    """
    kept = (
        nested.select(
            F.col("query_id").cast("long").alias("query_id"),
            "query",
            _flagged(1).alias("selected"),
            _flagged(0).alias("others"),
        )
        .where(F.size("selected") > 0)
    )
    if max_records is not None:
        # records that share an id are ordered by what they hold, so that the cap cuts between them
        total = [F.col("query_id"), F.xxhash64(*kept.columns), *map(F.col, kept.columns[1:])]
        ordered = running_sums(kept, [], total, {"_place": F.lit(1)})
        kept = ordered.where(F.col("_place") <= max_records).drop("_place")
    rows = F.concat(
        _labelled(F.col("selected"), POSITIVE),
        _labelled(F.slice("others", 1, max_negatives), NEGATIVE),
    )
    return kept.select("query_id", "query", F.inline(rows))


def nest_candidates(candidates: DataFrame) -> DataFrame:
    """Nested records from ranked candidates ``(query_id, query, rank, document, relevance)``.

    A passage is selected if it has the top grade. For top-k candidates, so a record stays small.
    """
    passage = F.struct(
        "rank", "document", (F.col("relevance") == POSITIVE).cast("int").alias("is_selected")
    )
    return (
        candidates.groupBy("query_id", "query")
        .agg(F.sort_array(F.collect_list(passage)).alias("ranked"))
        .select(
            "query_id",
            "query",
            F.struct(
                F.col("ranked.document").alias("passage_text"),
                F.col("ranked.is_selected").alias("is_selected"),
            ).alias("passages"),
        )
    )
