"""Continuous judgement building and search over a stream of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillrank.operators.bm25 import Bm25Index, bm25_retrieve
from quillrank.operators.judgements import MAX_NEGATIVES, build_judgements
from quillrank.operators.ranker import Ranker
from quillrank.plans.search import search
from quillrank.schemas import NESTED_RECORDS, QUERIES
from quillrank.session import discarding
from quillrank.sources.tables import ROWS_PER_SHARD


def stream_judgements(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    max_negatives: int = MAX_NEGATIVES,
    max_files_per_trigger: int = 1000,
    rows_per_shard: int = ROWS_PER_SHARD,
) -> StreamingQuery:
    """Turn nested records arriving as Parquet files into judgement shards, each exactly once.

    No file holds more than ``rows_per_shard`` rows.

    The plan is the batch one and keeps no state. Processes what is there and stops; started again
    with the same checkpoint it goes on with newer files.
    """
    records = (
        spark.readStream.schema(NESTED_RECORDS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
    )
    return (
        build_judgements(records, max_negatives)
        .writeStream.format("parquet")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_shard)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_queries(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    answer: Callable[[DataFrame], DataFrame],
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Answer queries ``(query_id, query)`` arriving as Parquet files, one job per micro-batch.

    A batch overwrites its own ``batch_id`` folder, so repeating it after a failure adds nothing. Its working
    tables are removed once its answers are written.
    """
    queries = (
        spark.readStream.schema(QUERIES)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        with discarding(batch.sparkSession):
            answer(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        batch.unpersist()

    return (
        queries.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def retrieval(index: Bm25Index, top_k: int = 10) -> Callable[[DataFrame], DataFrame]:
    """The first stage alone as an answer for :func:`stream_queries`."""
    return lambda queries: bm25_retrieve(queries, index, top_k)


def two_stage(
    index: Bm25Index, ranker: Ranker, terms: DataFrame, retrieve_top_k: int = 10
) -> Callable[[DataFrame], DataFrame]:
    """Retrieval and re-ranking as an answer for :func:`stream_queries`."""
    return lambda queries: search(queries, index, ranker, terms, retrieve_top_k)


def read_answers(spark: SparkSession, sink: str) -> DataFrame:
    """All answers so far, without the batch number."""
    return spark.read.parquet(sink).drop("batch_id")
