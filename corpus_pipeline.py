"""A training-corpus pipeline over ``documents``: five stages of operators from ``quillrank.llm``.

Each stage takes all rows that its predecessor kept and returns the columns of ``documents``, the last one
token counts and digests. Stages handle nulls, empty texts, repeated rows and empty tables as their operators
state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import byte_bpe, decontaminate, language_spans, line_chunks, ngram_join
from quillrank.session import materialise

#: Texts whose language is less certain than this, or that have no letters, go.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough; a missing ``lang`` is filled in.

    The model learns from the labelled texts of the stage's own input. Without any, nothing is rejected.
    """
    model = language_spans.fit(docs)
    return language_spans.accept(docs, model, MIN_LANGUAGE_SCORE) if model.languages else docs


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the line chunks that an earlier one holds; what has no word left then goes."""
    rows = line_chunks.remove_repeated_chunks(docs)
    rows = rows.where((F.col("n_removed") == 0) | (F.col("text") != ""))
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return rows.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text, decoded again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return byte_bpe.token_digests(docs, "doc_id", "text")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]
#: The language model and the byte pairs are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
