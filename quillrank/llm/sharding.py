"""Sharding by extendible hashing: a directory over hash prefixes in which only oversized buckets split.

A row's hash is 60 bits of the MD5 of its key and its content's MD5, so rows that share a key spread. The directory
starts with one bucket of no bits. A bucket above the byte limit splits on its next bit, until each fits
or holds one hash only. Rows of one hash are equal; if they exceed the limit together, they are numbered
and cut into overflow parts. A single row above the limit is a shard of its own.

Bytes are counted per prefix in Spark, a few bits deeper than the mean shard needs; only rows of buckets
that are still too large are counted again with more bits.

Defined results: a null key hashes as the word ``null``, a null text as an empty one of 0 bytes; empty rows go
to shards like all others; equal rows are interchangeable; further columns are left out by ``assign`` and
kept by ``write_shards``; an empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators.grouping import is_small, running_sums
from quillrank.session import materialise

BITS = 60
#: Bytes of text in a shard.
SHARD_BYTES = 1024 * 1024
#: Bits counted beyond those of the mean shard, and bits of each further round.
SLACK_BITS, ROUND_BITS = 3, 6
SMALL = 16 * 1024 * 1024


def row_hash(key: str, text: str) -> Column:
    own = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(own), 1, BITS // 4), 16, 10).cast("long")


def _prefix(hashed: str | Column, bits: int | Column) -> Column:
    """The first ``bits`` bits, as a number."""
    hashed = F.col(hashed) if isinstance(hashed, str) else hashed
    return F.call_function("shiftright", hashed, (F.lit(BITS) - bits).cast("int"))


def _too_large(limit: int) -> Column:
    return (F.col("bytes") > limit) & (F.col("low") < F.col("high"))


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))


def directory(rows: DataFrame, limit: int, first: int, last: int) -> DataFrame:
    """``cell, depth``: for each prefix of ``last`` bits the least depth, from ``first`` on, that fits.

    ``depth`` is null where even ``last`` bits are too few.
    """
    cells = _counted(rows.select(_prefix("hash", last).alias("cell"), "bytes", F.col("hash").alias("low"), F.col("hash").alias("high")), "cell")
    cells = materialise(cells, "shard-cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last))))
    levels = levels.withColumn("bucket", F.call_function("shiftright", F.col("cell"), F.lit(last) - F.col("depth")))
    buckets = _counted(levels, "depth", "bucket").where(~_too_large(limit)).select("depth", "bucket")
    fitting = levels.join(buckets, ["depth", "bucket"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return materialise(cells.select("cell").join(fitting, "cell", "left"), "shard-directory")


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """``key, hash, n_bytes, depth, bits, part`` of every row; ``(bits, part)`` names its shard.

    ``bits`` is the hash prefix of ``depth`` bits, as text; ``part`` is 0 but for overflow parts.
    """
    rows = df.select(
        F.col(key).alias("key"),
        row_hash(key, text).alias("hash"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
    )
    left = materialise(rows, "shard-rows")
    total = left.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    last = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SLACK_BITS)
    first, done = 0, None
    while True:
        cells = directory(left, limit, first, last)
        placed = left.withColumn("cell", _prefix("hash", last))
        placed = placed.join(F.broadcast(cells) if is_small(cells, SMALL) else cells, "cell")
        part = placed.where(F.col("depth").isNotNull()).select("key", "hash", "bytes", "depth")
        done = part if done is None else done.unionByName(part)
        if cells.where(F.col("depth").isNull()).isEmpty():
            break
        left = materialise(placed.where(F.col("depth").isNull()).select("key", "hash", "bytes"), "shard-rows")
        first, last = last + 1, min(BITS, last + ROUND_BITS)
    done = materialise(done, "shard-placed")
    # rows of one hash that do not fit together
    crowded = done.groupBy("hash").agg(F.sum("bytes").alias("all"), F.count(F.lit(1)).alias("n")).where(
        (F.col("all") > limit) & (F.col("n") > 1)
    )
    crowded = materialise(crowded.select("hash"), "shard-crowded")
    done = done.withColumn("part", F.lit(0).cast("long"))
    if not crowded.isEmpty():
        side = F.broadcast(crowded) if is_small(crowded, SMALL) else crowded
        numbered = done.drop("part").join(side, "hash", "left_semi").withColumn("place", F.monotonically_increasing_id())
        numbered = running_sums(materialise(numbered, "shard-overflow"), ["hash"], [F.col("place")], {"rank": F.lit(1)})
        room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))
        numbered = numbered.withColumn("part", F.floor((F.col("rank") - 1) / room).cast("long")).drop("place", "rank")
        done = done.join(side, "hash", "left_anti").unionByName(numbered)
    return done.select(
        F.col("key").alias(key), "hash", F.col("bytes").alias("n_bytes"), "depth",
        F.lpad(F.bin(_prefix("hash", F.col("depth"))), F.col("depth"), F.lit("0")).alias("bits"), "part",
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> None:
    """The rows of ``df`` as Parquet, one folder ``bits=.../part=...`` a shard, in hash order.

    Equal rows of an overflow bucket are dealt to its parts in turn.
    """
    shards = assign(df, key, text, limit).groupBy("hash", "bits").agg(
        (F.max("part") + 1).alias("parts"), F.max(F.struct("part", "n_bytes"))["n_bytes"].alias("_size")
    )
    rows = df.withColumn("_hash", row_hash(key, text))
    joined = rows.join(shards.withColumnRenamed("hash", "_hash"), "_hash")
    many = joined.where("parts > 1").withColumn("_place", F.monotonically_increasing_id())
    many = running_sums(materialise(many, "shard-write"), ["_hash"], [F.col("_place")], {"_rank": F.lit(1)})
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_size")))
    many = many.withColumn("part", F.floor((F.col("_rank") - 1) / room).cast("long")).drop("_place", "_rank")
    placed = joined.where("parts = 1").withColumn("part", F.lit(0).cast("long")).unionByName(many)
    placed = placed.withColumn("bits", F.concat(F.lit("b"), "bits")).repartition("bits", "part")
    placed.sortWithinPartitions("bits", "part", "_hash").drop("_hash", "_size", "parts").write.partitionBy("bits", "part").parquet(path)
