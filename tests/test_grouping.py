import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillrank.operators.grouping import (
    hashed_order,
    is_small,
    measured_bytes,
    running_sums,
    skew_join,
    top_k_per_group,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows; many ties; a null key."""
    rng = random.Random(7)
    rows = [("hot", rng.randint(0, 5), i) for i in range(400)]
    rows += [(rng.choice(["a", "b", None]), rng.randint(0, 5), i) for i in range(400, 600)]
    return spark.createDataFrame(rows, "k STRING, score INT, id LONG").repartition(6)


def test_running_sums_equal_for_windowed_and_spread_groups(skewed):
    order, sums = [F.col("score").desc(), F.col("id")], {"rank": F.lit(1), "total": F.col("score")}
    plain = running_sums(skewed, ["k"], order, sums)
    spread = running_sums(skewed, ["k"], order, sums, hot_rows=30)
    assert rows_of(plain, "id") == rows_of(spread, "id")
    expected = {}
    for k, score, i in sorted(skewed.collect(), key=lambda r: (-r[1], r[2])):
        rank, total = expected.get((k, "last"), (0, 0))
        expected[k, "last"] = (rank + 1, total + score)
        expected[i] = expected[k, "last"]
    assert {row["id"]: (row["rank"], row["total"]) for row in plain.collect()} == {
        i: value for i, value in expected.items() if isinstance(i, int)
    }


def test_running_sums_over_everything(spark):
    df = spark.range(0, 100, 1, 7).withColumn("v", F.col("id") % 3)
    got = running_sums(df, [], [F.col("id").desc()], {"place": F.lit(1)})
    assert rows_of(got.select("id", "place"), "id") == [(i, 100 - i) for i in range(100)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("counted", [True, False])
def test_skew_join_equals_plain_join(spark, skewed, how, counted):
    rows = skewed.where(F.col("k").isNotNull())
    per_key = spark.createDataFrame([("hot", 400, "x"), ("a", 100, "y")], "k STRING, n INT, v STRING")
    size = F.col("n") if counted else None
    got = skew_join(rows, per_key, ["k"], ["id"], size, how, hot_rows=30)
    plain = rows.join(per_key, ["k"], how)
    assert got.columns == plain.columns
    assert rows_of(got, "id") == rows_of(plain, "id")


@pytest.mark.parametrize("k", [1, 3, 1500])
def test_top_k_per_group(skewed, k):
    got = top_k_per_group(skewed, ["k"], [F.col("score").desc(), F.col("id")], k)
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row["k"], []).append((-row["score"], row["id"]))
    expected = {i: place + 1 for g in groups.values() for place, (_, i) in enumerate(sorted(g)[:k])}
    assert {row["id"]: row["rank"] for row in got.collect()} == expected


def test_hashed_order_numbers_keys_in_md5_order(spark):
    import hashlib

    keys = spark.range(500).withColumn("weight", F.col("id") % 4)
    got = {r["id"]: r["position"] for r in hashed_order(keys, ["id"], 42, F.col("weight")).collect()}
    total = 0
    for i in sorted(range(500), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest()):
        total += i % 4
        assert got[i] == total


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abcd", [1, 2]), (None, None)], "s STRING, a ARRAY<INT>")
    assert measured_bytes(df) == 2 * 16 + 4 + (16 + 2 * 8)
    assert is_small(df) and not is_small(df, 10)
    assert measured_bytes(df.limit(0)) == 0
