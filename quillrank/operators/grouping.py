"""Per-group ranks, running sums, top-k and joins that survive one very large group.

Any key may hold a third of all rows, so no function here gathers a whole group in one task:
top-k cuts each task's rows before the shuffle, running sums range-sort large groups over many
tasks, and joins split large keys over several salts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.functions.text import seeded_hash

# A group above this many rows is spread over several tasks.
HOT_ROWS = 2_000_000
# A table is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# Largest k for which Spark cuts the rows of a group before the shuffle (its default setting).
PRE_SHUFFLE_TOP_K = 1000

_SALT, _SALTS = "_salt", "_salts"


def _value_bytes(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(data_type, T.ArrayType):
        element = data_type.elementType
        return F.coalesce(
            F.aggregate(column, F.lit(16).cast("long"), lambda total, item: total + _value_bytes(item, element)),
            F.lit(0).cast("long"),
        )
    if isinstance(data_type, T.StructType):
        total = F.lit(8).cast("long")
        for field in data_type.fields:
            total = total + _value_bytes(column[field.name], field.dataType)
        return total
    return F.lit(8).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of ``df``, by one distributed pass that returns a single number."""
    row = F.lit(16).cast("long")
    for field in df.schema.fields:
        row = row + _value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven to fit a broadcast."""
    return measured_bytes(df) <= max_bytes


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered from 1 in ``rank``."""
    if k > PRE_SHUFFLE_TOP_K:
        # Spark no longer cuts before the shuffle: do it per slice of each group first.
        slices = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(64))
        local = Window.partitionBy(*group, _SALT).orderBy(*order)
        df = (
            df.withColumn(_SALT, slices)
            .withColumn(rank, F.row_number().over(local))
            .where(F.col(rank) <= k)
            .drop(_SALT, rank)
        )
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def skew_join(
    rows: DataFrame,
    per_key: DataFrame,
    key: Sequence[str],
    salt_by: Sequence[str],
    size: Column | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join many ``rows`` with a ``per_key`` table of one row per key, split for large keys.

    ``size`` says how many ``rows`` a key has, as an expression over ``per_key``; without it the
    rows are counted. If no key exceeds ``hot_rows`` this is a plain join. Otherwise a large key
    gets as many salts as it has multiples of ``hot_rows``, and its one row is copied to each. The
    broadcast list of large keys has at most ``total / hot_rows`` entries. ``per_key`` is read more
    than once, so pass a stored table.
    """
    key = list(key)
    if size is None:
        sizes = rows.groupBy(*key).agg(F.count("*").alias("_size"))
    else:
        sizes = per_key.select(*key, size.alias("_size"))
    salts = F.ceil(F.col("_size") / F.lit(hot_rows)).cast("int").alias(_SALTS)
    hot = sizes.where(F.col("_size") > hot_rows).select(*key, salts)
    if hot.isEmpty():
        return rows.join(per_key, key, how)
    hot = F.broadcast(hot.persist())
    n_salts = F.coalesce(F.col(_SALTS), F.lit(1))
    slot = F.pmod(F.xxhash64(*[F.col(name) for name in salt_by]), n_salts).cast("int")
    salted = rows.join(hot, key, "left").withColumn(_SALT, slot).drop(_SALTS)
    copies = (
        per_key.join(hot, key, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), n_salts - 1)))
        .drop(_SALTS)
    )
    return salted.join(copies, key + [_SALT], how).drop(_SALT)


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add inclusive running sums of long expressions within each group, in ``order``.

    ``order`` must be a total order inside a group. A running sum of ``lit(1)`` is the rank. Groups
    of up to ``hot_rows`` use a window. Larger ones are range-sorted over all tasks; each task's
    share of a group is summed locally and offset by the totals of the shares before it.
    """
    group = list(group)
    if group:
        hot = df.groupBy(*group).count().where(F.col("count") > hot_rows).select(*group)
        if hot.isEmpty():
            return _windowed_sums(df, group, order, sums)
        hot = hot.persist()
        null_safe = [F.col(f"rows.{name}").eqNullSafe(F.col(f"hot.{name}")) for name in group]
        rows, keys = df.alias("rows"), F.broadcast(hot.alias("hot"))
        spread = _range_sorted_sums(rows.join(keys, null_safe, "left_semi"), group, order, sums)
        rest = _windowed_sums(rows.join(keys, null_safe, "left_anti"), group, order, sums)
        return rest.unionByName(spread)
    return _range_sorted_sums(df, group, order, sums)


def _windowed_sums(
    df: DataFrame, group: list[str], order: Sequence[Column], sums: Mapping[str, Column]
) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.sum(value.cast("long")).over(window) for name, value in sums.items()})


def _range_sorted_sums(
    df: DataFrame, group: list[str], order: Sequence[Column], sums: Mapping[str, Column]
) -> DataFrame:
    # Row ids grow in sort order: the upper bits number the task, the lower bits the row in it.
    # The checkpoint fixes them, so both uses below see the same ids even after a lost executor.
    numbered = (
        df.orderBy(*group, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({f"_add_{name}": value.cast("long") for name, value in sums.items()})
        .withColumn("_share", F.shiftright("_row", 33))
        .checkpoint()
    )
    # At most one row per task and group boundary.
    totals = numbered.groupBy(*group, "_share").agg(
        *[F.sum(f"_add_{name}").alias(f"_total_{name}") for name in sums]
    )
    before = Window.partitionBy(*group).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(name).alias(f"_key_{name}") for name in group],
        F.col("_share").alias("_key_share"),
        *[F.coalesce(F.sum(f"_total_{name}").over(before), F.lit(0)).alias(f"_base_{name}") for name in sums],
    )
    matches = [F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in group]
    inside = (
        Window.partitionBy(*group, "_share").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    )
    offsets = F.broadcast(offsets) if is_small(offsets) else offsets
    return (
        numbered.join(offsets, [*matches, F.col("_share") == F.col("_key_share")])
        .withColumns({
            name: F.col(f"_base_{name}") + F.sum(f"_add_{name}").over(inside) for name in sums
        })
        .select(*df.columns, *sums)
    )


def hashed_order(
    keys: DataFrame, key: Sequence[str], seed: int | str, weight: Column | None = None
) -> DataFrame:
    """Shuffle distinct ``keys`` reproducibly: add ``hash`` and the running weight ``position``.

    The order is ``md5(seed|key)``. Hashes spread evenly, so their first four digits cut the keys
    into 65,536 equal buckets; a position is the total of the buckets before plus the running sum
    inside the bucket. Only the 65,536 bucket totals ever meet in one task.
    """
    hashed = keys.withColumn("hash", seeded_hash(seed, *[F.col(name) for name in key])).withColumns({
        "_bucket": F.substring("hash", 1, 4),
        "_weight": (F.lit(1) if weight is None else weight).cast("long"),
    })
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        hashed.groupBy("_bucket")
        .agg(F.sum("_weight").alias("_total"))
        .select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    inside = (
        Window.partitionBy("_bucket")
        .orderBy("hash", *key)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        hashed.join(F.broadcast(bases), "_bucket")
        .withColumn("position", F.col("_base") + F.sum("_weight").over(inside))
        .drop("_bucket", "_weight", "_base")
    )
