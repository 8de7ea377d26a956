"""CSV, Parquet, JSON and log readers and writers, with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillrank.operators.grouping import running_sums
from quillrank.operators.labels import cap_whole_queries
from quillrank.schemas import EXPERIMENT_LOG, JUDGEMENT_SHARD, NESTED_RECORDS
from quillrank.session import materialise, remove_paths

ROWS_PER_SHARD = 250_000


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header, split over tasks. Files whose quoted values span lines need ``multiline=True``,
    which reads each file in one task. A missing path raises ``FileNotFoundError``."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", multiline)
    return _existing(lambda: reader.option("quote", '"').option("escape", '"').csv(path), "Data", path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, what: str = "Data"
) -> DataFrame:
    df = _existing(lambda: spark.read.parquet(path), what, path)
    return df.select(*columns) if columns else df


def scan_capped(
    spark: SparkSession, path: str, max_rows: int | None = None, seed: int = 42
) -> DataFrame:
    """The judgement shards below ``path``: their four columns, all rows or whole queries up to ``max_rows``.

    Raises ``RuntimeError`` if there are no shards or no rows.
    """
    try:
        shards = read_parquet(spark, path, JUDGEMENT_SHARD.fieldNames())
    except FileNotFoundError:
        raise RuntimeError(f"No parquet shards found in {path}") from None
    if shards.isEmpty():
        raise RuntimeError(f"No rows found in {path}")
    return cap_whole_queries(shards, max_rows, seed)


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NESTED_RECORDS).parquet(path)


def write_shards(df: DataFrame, path: str, rows_per_shard: int = ROWS_PER_SHARD) -> None:
    """zstd Parquet files of at most ``rows_per_shard`` rows."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    writer.option("maxRecordsPerFile", rows_per_shard).parquet(path)


def write_shards_to_target(
    df: DataFrame,
    path: str,
    target_bytes: int,
    order: Sequence[str] = ("query_id", "relevance", "document"),
    rows_per_shard: int = ROWS_PER_SHARD,
) -> DataFrame:
    """Numbered zstd shards ``shard=0, 1, ...`` of ``rows_per_shard`` rows, up to and with the one that reaches ``target_bytes``.

    Returns ``(shard, bytes, total_bytes)`` of what was written, fewer bytes than the target if the rows run out. Rows
    are numbered in ``order`` (equal rows need no order); what the target leaves out is never encoded, but for a
    wave's estimate: each wave of shards is one job, as large as the bytes per shard so far let expect, and shards
    beyond the target are removed again. An empty ``df`` gives no shards.
    """
    spark = df.sparkSession
    place = running_sums(df, [], [F.col(name) for name in order], {"_place": F.lit(1)})
    shard = F.floor((F.col("_place") - 1) / F.lit(rows_per_shard)).cast("int")
    numbered = materialise(place.withColumn("shard", shard).drop("_place"), "numbered-rows")
    shards = numbered.agg(F.coalesce(F.max("shard") + 1, F.lit(0))).first()[0]
    sizes = spark.createDataFrame([], "shard int, bytes long, total_bytes long")
    numbered.where(F.lit(False)).drop("shard").write.mode("overwrite").option("compression", "zstd").parquet(path)
    written, total = 0, 0
    while written < shards and total < target_bytes:
        wave = 1 if not written else max(1, int((target_bytes - total) * written / max(1, total)))
        last = min(shards, written + wave)
        rows = numbered.where((F.col("shard") >= written) & (F.col("shard") < last)).repartition("shard")
        rows.write.mode("append").option("compression", "zstd").partitionBy("shard").parquet(path)
        written = last
        sizes = _shard_sizes(spark, path)
        total = sizes.agg(F.max("total_bytes")).first()[0]
    beyond = sizes.where(F.col("total_bytes") - F.col("bytes") >= target_bytes)
    remove_paths(spark, [f"{path}/shard={row['shard']}" for row in beyond.toLocalIterator()])
    return sizes.where(F.col("total_bytes") - F.col("bytes") < target_bytes)


def _shard_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One small row a shard: its bytes and those up to it, fixed at the time of the call."""
    files = spark.read.parquet(path).select("shard", "_metadata.file_path", "_metadata.file_size").distinct()
    sizes = files.groupBy("shard").agg(F.sum("file_size").alias("bytes"))
    running = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return materialise(sizes.withColumn("total_bytes", F.sum("bytes").over(running)), "shard-sizes")


def dataset_metadata(spark: SparkSession, path: str, **settings: object) -> DataFrame:
    """One row about written shards: rows, queries, shards and bytes, with the given settings."""
    shards = spark.read.parquet(path)
    files = shards.select("_metadata.file_path", "_metadata.file_size").distinct()
    sizes = files.agg(
        F.count("*").alias("shards"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes_written")
    )
    counts = shards.agg(
        F.count("*").alias("rows_written"), F.countDistinct("query_id").alias("queries_seen")
    )
    return counts.select(
        "rows_written",
        "queries_seen",
        sizes.select("shards").scalar().alias("shards"),
        sizes.select("bytes_written").scalar().alias("bytes_written"),
        (sizes.select("bytes_written").scalar() / F.lit(1024.0**3)).alias("written_gb"),
        *[F.lit(value).alias(name) for name, value in settings.items()],
    )


def write_json(one_row: DataFrame, path: str) -> None:
    """A report or metadata row as one JSON file."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def log_experiment(
    spark: SparkSession,
    path: str,
    name: str,
    features: Sequence[str],
    metrics: Mapping[str, float],
    notes: str = "",
) -> None:
    """Append one run to the log table; absent metrics count as 0."""
    row = (
        name,
        ",".join(features),
        float(metrics.get("ndcg", 0.0)),
        float(metrics.get("mrr", 0.0)),
        float(metrics.get("map", 0.0)),
        notes,
    )
    spark.createDataFrame([row], EXPERIMENT_LOG).coalesce(1).write.mode("append").parquet(path)


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    return _existing(lambda: spark.read.schema(EXPERIMENT_LOG).parquet(path), "Experiment log", path)


def search_json(results: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """``(query_id, response)``: the ranked results of each query as one JSON record."""
    fields = list(fields or [c for c in results.columns if c not in ("query_id", "query")])
    fields = ["rank"] + [name for name in fields if name != "rank"]
    return (
        results.groupBy("query_id", "query")
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("results"))
        .select("query_id", F.to_json(F.struct("query", "results")).alias("response"))
    )


def _existing(read, what: str, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{what} not found: {path}") from None
        raise
