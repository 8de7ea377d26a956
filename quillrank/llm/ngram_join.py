"""Near-duplicate join: MinHash banding on word n-grams, every pair verified on full n-gram sets.

Texts are compared as sets of ``N`` consecutive words (lower case, runs of word characters). Bands and
rows come from the wanted recall at the threshold (``choose_bands``). Texts with equal word sequences
form one class, and only classes go on. Classes that share a band hash are candidates:

* hashes shared by up to ``SMALL_BUCKET`` classes give candidate pairs, at most half as many per class;
* classes that share larger ones are gathered into clusters; within a cluster every pair is verified by
  tasks that take two blocks of up to ``BLOCK`` classes and return sums and a spanning forest, not pairs.

Results are one row per text: ``class_id``, the lowest key among the texts it is linked with directly or
through others, and ``n_links``, the number of other texts with a similarity of at least ``THRESHOLD``.

Defined results: texts of under ``N`` words have one n-gram, all their words; null texts and texts without
words are linked with nothing and their own class, but in ``keep_one`` all empty texts are one group, as
are all nulls; repeated rows count as texts of their own; ties go to the lowest key, then the lowest text
hash, nulls first; texts are never cut; further columns are kept by ``keep_one``; empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import give_back, held, let_workers_import, map_batches
from quillrank.operators.grouping import is_small
from quillrank.session import materialise

N, THRESHOLD, RECALL = 5, 0.8, 0.9999
MAX_HASHES = 256
SMALL_BUCKET, BLOCK = 16, 512
#: Columns of the incidence matrix that a block task multiplies at once.
COLUMNS = 4096
#: Word hashes that a Python worker remembers; beyond it they are emptied.
REMEMBERED = 100_000
#: Rows of an Arrow batch that are turned into Python objects at once.
AT_ONCE = 512
SMALL = 16 * 1024 * 1024
WORD = re.compile(r"\w+")


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows a band, so that the fewest unlike pairs meet, for which ``most``
    hashes still find a pair at the threshold with the wanted probability."""
    best = None
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows))))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("too few hashes for this threshold and recall")
    return best


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def ngram_set(words: list[str], n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams."""
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(held("word hashes", _Words).__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    mixed = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ values[i : len(values) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@lru_cache(maxsize=4)
def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(20_231))
    odd = draw.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], draw.integers(0, 1 << 63, count, np.uint64)[:, None]


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> list[int]:
    """One signed 64-bit hash a band, of the band's number and its rows' minima."""
    factors, shifts = _factors(bands * rows)
    minima = np.full(bands * rows, np.uint64((1 << 64) - 1))
    for at in range(0, len(grams), 1024):
        part = factors * grams[None, at : at + 1024] + shifts
        minima = np.minimum(minima, part.min(1))
    raw = minima.reshape(bands, rows).tobytes()
    width = 8 * rows
    return [
        xxhash.xxh64_intdigest(raw[band * width : (band + 1) * width], band) - (1 << 63) for band in range(bands)
    ]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def _raw(text: str) -> Column:
    """Digest of the text as it is; null texts have one of their own."""
    return F.coalesce(F.md5(text), F.lit("null"))


def signatures(df: DataFrame, key: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """``key, raw, digest, bands``: digests of the text and of its words (null if none), band hashes."""
    kept = df.select(F.col(key).alias("key"), _raw(text).alias("raw"), F.col(text).alias("text"))
    kind = kept.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            digests: list[bytes | None] = []
            hashes: list[list[int] | None] = []
            for content in batch.column(2).to_pylist():
                words = WORD.findall((content or "").lower())
                digests.append(hashlib.md5(" ".join(words).encode()).digest() if words else None)
                hashes.append(band_hashes(ngram_set(words, n), bands, rows) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
                ["key", "raw", "digest", "bands"],
            )
        give_back("word hashes")

    return map_batches(kept, run, f"key {kind}, raw string, digest binary, bands array<long>")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for edges ``a, b``: connected components by alternating star contraction.

    Each round connects a node's larger neighbours, then its smaller ones, to the least of them. Minima are
    aggregated before the shuffle, and the joins have one row a key on one side, so that a node with very
    many neighbours can be split. Every round is written to the shared folder.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = materialise(now, "edges"), None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # least of a node's smaller neighbours, each of which is then tied to it
        large = materialise(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = materialise(small.distinct(), "small-star")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _joined(df: DataFrame, side: DataFrame, on, how: str) -> DataFrame:
    return df.join(F.broadcast(side) if is_small(side, SMALL) else side, on, how)


def _verified_pairs(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """``a, b`` of the pairs with the similarity, from both texts' whole n-gram sets."""
    with_texts = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def grams(cid: int, content: str) -> np.ndarray:
            if cid not in known:
                if len(known) >= AT_ONCE:
                    known.clear()
                known[cid] = ngram_set(WORD.findall(content.lower()), n)
            return known[cid]

        for batch in _sliced(batches):
            a, b, text_a, text_b = (column.to_pylist() for column in batch.columns)
            keep = []
            for i in range(batch.num_rows):
                x, y = grams(a[i], text_a[i]), grams(b[i], text_b[i])
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= threshold * (len(x) + len(y) - shared) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(with_texts.select("a", "b", "text_a", "text_b"), run, "a long, b long")


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set."""
    counts = np.zeros((len(left), len(right)), np.float32)
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    for at in range(0, len(common), COLUMNS):
        part = common[at : at + COLUMNS]
        sides = []
        for sets in (left, right):
            rows = np.zeros((len(sets), len(part)), np.float32)
            for i, own in enumerate(sets):
                lo, hi = np.searchsorted(own, [part[0], part[-1]], side="left")
                inside = own[lo : hi + 1]
                place = np.searchsorted(part, inside)
                place[place == len(part)] = 0
                rows[i, place[part[place] == inside]] = 1
            sides.append(rows)
        counts += sides[0] @ sides[1].T
    return counts


def _within_clusters(placed: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links of all pairs within clusters, as rows ``cid, other, links``.

    ``placed`` has ``root, cid, copies, text, blocks, block``. Each class goes to the tasks of its block
    with every block of its cluster. A row has the copies a class is linked to there, and, in ``other``, a
    class that it is linked to, such that these form a spanning forest of the task's links.
    """
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, high = key[1], key[2]
        sets = [ngram_set(WORD.findall(content.lower()), n) for content in rows["text"]]
        block, cid, copies = (rows[name].to_numpy() for name in ("block", "cid", "copies"))
        first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if not len(first) or not len(second):
            return pd.DataFrame({"cid": [], "other": [], "links": []}).astype("int64")
        shared = _shared_counts([sets[i] for i in first], [sets[i] for i in second])
        sizes = np.array([len(own) for own in sets], np.float32)
        alike = shared >= threshold * (sizes[first][:, None] + sizes[second][None] - shared) - 1e-4
        if low == high:
            np.fill_diagonal(alike, False)
        links = np.zeros(len(sets), np.int64)
        links[first] += alike @ copies[second]
        if low != high:
            links[second] += alike.T @ copies[first]
        parent = list(range(len(sets)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        other = cid.copy()
        for i, own in enumerate(alike):
            for j in np.flatnonzero(own).tolist():
                a, b = root(first[i]), root(second[j])
                if a != b:
                    a, b = (a, b) if cid[a] < cid[b] else (b, a)
                    parent[b] = a
                    other[b] = cid[a]
        touched = np.flatnonzero(links)
        return pd.DataFrame({"cid": cid[touched], "other": other[touched], "links": links[touched]})

    let_workers_import(placed.sparkSession)
    columns = dealt.select("root", "low", "high", "cid", "copies", "block", "text")
    return columns.groupBy("root", "low", "high").applyInPandas(run, "cid long, other long, links long")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``df``: ``key, raw, class_id, class_raw, n_links``.

    ``raw`` is the text's digest; ``(class_id, class_raw)`` is the lowest key and digest of its group.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = materialise(signatures(df, key, text, n, bands, rows), "signatures")
    classes = (
        signed.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("key", "raw")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = materialise(classes, "classes")
    buckets = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("least")).where("n > 1")
    members = materialise(buckets.join(shared, "bucket"), "members")
    hot = members.where(F.col("n") > SMALL_BUCKET)
    clusters = materialise(components(hot.select(F.col("cid").alias("a"), F.col("least").alias("b"))), "clusters")
    roots = clusters.union(clusters.select("root", "root").distinct())
    # candidate pairs of the small buckets, but for those within one cluster
    few = members.where(F.col("n") <= SMALL_BUCKET).join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    few = few.select("bucket", "cid", "root")
    left, right = few.toDF("bucket", "a", "root_a"), few.toDF("bucket", "b", "root_b")
    pairs = left.join(right, "bucket").where("a < b and (root_a is null or root_b is null or root_a <> root_b)")
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    # texts of the classes that take part, from one pass over the documents
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).union(roots.select("node")).distinct()
    wanted = materialise(
        classes.join(wanted, "cid").select("cid", F.col("rep.key").alias("key"), F.col("rep.raw").alias("raw")), "wanted"
    )
    held = df.select(F.col(key).alias("key"), _raw(text).alias("raw"), F.col(text).alias("text"))
    held, wanted = held.alias("d"), wanted.alias("w")
    same = F.col("d.key").eqNullSafe(F.col("w.key")) & (F.col("d.raw") == F.col("w.raw"))
    texts = _joined(held, wanted, same, "inner").select("w.cid", "d.text").dropDuplicates(["cid"])
    texts = materialise(texts, "texts")
    linked = materialise(_verified_pairs(pairs, texts, n, threshold), "linked")
    sizes = roots.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = (
        roots.withColumnRenamed("node", "cid")
        .join(sizes, "root")
        .join(texts, "cid")
        .join(classes.select("cid", "copies"), "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    )
    inside = materialise(_within_clusters(placed, n, threshold), "inside")
    edges = linked.union(inside.where("cid <> other").select("cid", "other"))
    groups = components(edges)
    both = linked.union(linked.select("b", "a")).toDF("cid", "other")
    counts = both.join(classes.select(F.col("cid").alias("other"), F.col("copies").alias("links")), "other")
    counts = counts.select("cid", "links").union(inside.select("cid", "links"))
    counts = counts.groupBy("cid").agg(F.sum("links").alias("links"))
    rooted = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cid")).join(counts, "cid", "left")
    rooted = rooted.select(
        "digest", "root", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    firsts = rooted.groupBy("root").agg(F.min("rep").alias("first"))
    of_class = materialise(rooted.join(firsts, "root").select("digest", "first", "n_links"), "class-results")
    out = _joined(signed.select("key", "raw", "digest"), of_class, "digest", "left")
    alone = F.struct("key", "raw")
    return out.select(
        "key",
        "raw",
        F.coalesce("first", alone)["key"].alias("class_id"),
        F.coalesce("first", alone)["raw"].alias("class_raw"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("digest").isNull().alias("wordless"),
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` less all but the first of every group."""
    found = materialise(near_duplicates(df, key, text, **options), "near-duplicates")
    own = F.struct("key", "raw")
    wordless = found.where("wordless").groupBy("raw").agg(F.min(own).alias("first"))
    of_wordless = found.where("wordless").join(wordless, "raw").where(own != F.col("first")).select("key", "raw")
    gone = found.where((~F.col("key").eqNullSafe(F.col("class_id"))) | (F.col("raw") != F.col("class_raw")))
    gone = materialise(gone.select("key", "raw").union(of_wordless).distinct(), "gone").alias("g")
    # the row as one struct, so that no name of its columns can clash
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("key"), _raw(text).alias("raw")).alias("r")

    def same(name: str) -> Column:
        return F.col("r.key").eqNullSafe(F.col(f"{name}.key")) & (F.col("r.raw") == F.col(f"{name}.raw"))

    left = _joined(rows, gone, same("g"), "left_anti")
    twins = found.groupBy("key", "raw").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "raw")
    twins = materialise(twins, "twins").alias("t")
    if not twins.isEmpty():
        single = _joined(left, twins, same("t"), "left_anti")
        first = _joined(left, twins, same("t"), "left_semi").dropDuplicates(["key", "raw"])
        left = single.unionByName(first)
    return left.select("row.*")
