"""Shards up to a byte target, exact record caps and embeddings by plain Python."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillrank.operators.judgements import build_judgements
from quillrank.operators.semantic import text_embed
from quillrank.schemas import JUDGEMENT_SHARD, NESTED_RECORDS
from quillrank.sources import tables


def some_rows(n):
    draw = random.Random(n)
    return [(i // 4, f"query {i // 4}", " ".join(str(draw.random()) for _ in range(30)), i % 4 // 3) for i in range(n)]


@pytest.mark.parametrize("target_shards, expected", [(0.0, 0), (0.5, 1), (1.0, 1), (2.4, 3), (3.5, 4), (99.0, 5)])
def test_shards_stop_at_the_byte_target(spark, tmp_path, target_shards, expected):
    rows = spark.createDataFrame(some_rows(470), JUDGEMENT_SHARD).repartition(3)
    path = str(tmp_path / "all")
    whole = tables.write_shards_to_target(rows, path, 1 << 40, rows_per_shard=100).orderBy("shard").collect()
    assert [r["shard"] for r in whole] == [0, 1, 2, 3, 4]
    target = math.floor(target_shards * whole[0]["bytes"])
    path = str(tmp_path / "capped")
    sizes = tables.write_shards_to_target(rows, path, target, rows_per_shard=100).orderBy("shard").collect()
    assert [tuple(r) for r in sizes] == [tuple(r) for r in whole[:expected]]
    assert all(r["total_bytes"] - r["bytes"] < target for r in sizes)
    if not expected:
        assert spark.read.parquet(path).count() == 0
        return
    assert expected == 5 or sizes[-1]["total_bytes"] >= target
    written = tables.scan_capped(spark, path).orderBy("query_id", "relevance", "document").collect()
    wanted = rows.orderBy("query_id", "relevance", "document").limit(min(470, 100 * expected)).collect()
    assert [tuple(r) for r in written] == [tuple(r) for r in wanted]
    per_shard = spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("_metadata.file_path").alias("files"))
    assert all((r["n"], r["files"]) == (70 if r["shard"] == 4 else 100, 1) for r in per_shard.collect())
    meta = tables.dataset_metadata(spark, path).first()
    assert (meta["rows_written"], meta["shards"]) == (min(470, 100 * expected), expected)
    assert meta["bytes_written"] == sizes[-1]["total_bytes"]


def test_shards_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], JUDGEMENT_SHARD)
    assert tables.write_shards_to_target(empty, str(tmp_path / "none"), 1000).count() == 0


def test_record_cap_cuts_between_records_of_one_id(spark):
    rows = [(7, f"q{i % 3}", ([f"p{i}"], [1])) for i in range(9)] + [(8, "q", (["p"], [1]))] * 3 + [(1, "q", (["p"], [0]))]
    nested = spark.createDataFrame(rows, NESTED_RECORDS)
    for cap in (0, 1, 4, 9, 10, 11, 12, 50):
        got = build_judgements(nested, max_records=cap)
        assert got.count() == min(cap, 12)
        assert got.where("query_id = 8").count() == max(0, min(cap, 12) - 9)


def test_embedding_equals_plain_counts(spark):
    draw = random.Random(3)
    vocabulary = ["running", "runs", "run", "a", "laptop", "laptops", "x1", "abcdef"]
    texts = [None, "", "  ", *(" ".join(draw.choices(vocabulary, k=draw.randint(1, 30))) for _ in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING").repartition(3)
    for row in text_embed(df, "text", dimensions=16).collect():
        counts = Counter()
        for word in (row["text"] or "").split():
            for piece in (word, "5:" + word[:5], "4:" + word[:4]):
                counts[int(hashlib.md5(piece.encode()).hexdigest()[:15], 16) % 16] += 1
        norm = math.sqrt(sum(n * n for n in counts.values())) or 1.0
        assert row["vector"] == pytest.approx([counts[i] / norm for i in range(16)])
