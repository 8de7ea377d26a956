"""Token ids in Simple-8b blocks, written as a dataset of files and read back by numpy.

File format: a folder of Parquet part files whose rows are blocks, in ascending order of key. A block
holds up to ``BLOCK_IDS`` ids or the ids of one longer document; a document never spans two blocks:

* ``part``, ``block``: place of the block; ``first_token``: ids before it in its part;
* ``keys``, ``lengths``: the documents of the block and their numbers of ids;
* ``words``: 64-bit little-endian words. The low four bits choose how many ids of how many bits fill
  the other sixty (``LAYOUTS``); the first id is in the lowest bits;
* ``escapes``: ids of 2**30 - 1 or more, in order. Such an id is coded as thirty one-bits.

Defined results: a null or empty text has the end id alone; rows that share a key follow each other in
the order of their text's hash, nulls first; further columns are ignored; an empty table gives an empty
dataset; texts are never cut; the strings of special tokens count as the tokenizer's file says.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.llm.common import held, map_batches
from quillrank.operators.grouping import is_small

# Fixed values: (ids in a word, bits of each) by selector; selectors 0 and 1 are runs of zeros.
LAYOUTS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = (1 << 30) - 1
BLOCK_IDS = 65_536
#: Words that a Python worker remembers with their ids; beyond it the memory is emptied.
REMEMBERED = 1_200_000
# Fixed value: marks that are neither letters, digits nor apostrophes.
MARKS = b'.,!?;:#$%&*|<>()"-'
#: Texts whose new words are encoded together.
TEXTS_AT_ONCE = 64
BLOCKS = (
    "part int, block int, first_token long, keys array<long>, lengths array<int>, "
    "words binary, escapes array<long>"
)


def _widths() -> np.ndarray:
    """The least layout width of each id up to 2**16."""
    ids, out = np.arange((1 << 16) + 1), np.full((1 << 16) + 1, 20, np.uint8)
    for width in (15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0):
        out[ids < (1 << width)] = width
    return out


_WIDTHS = _widths()


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of non-negative ids; each word takes as many ids as its best layout holds.

    The last word may have free room; the number of ids is known from the lengths.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    escapes = ids[ids >= ESCAPE]
    coded = np.minimum(ids, np.uint64(ESCAPE)).astype(np.uint32)
    layout_bits = np.array([b for _, b in LAYOUTS], np.uint8)
    needed = _WIDTHS[np.minimum(coded, 1 << 16)]
    needed[coded >= 1 << 20] = 30
    selector = np.full(n, 15, np.uint8)
    window, widest = 1, needed
    for choice in range(14, -1, -1):  # from few wide ids to many narrow ones
        count, width = LAYOUTS[choice]
        if count > n:
            count = n
        while window < count:  # the widest of a window, from the widest of two shorter ones
            step = min(window, count - window)
            shifted = np.zeros_like(widest)
            shifted[: n - step] = widest[step:]
            widest = np.maximum(widest, shifted)
            window += step
        selector[widest <= layout_bits[choice]] = choice
    step = np.array([count for count, _ in LAYOUTS])[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts] if n else np.zeros(0, np.uint8)
    words = chosen.astype(np.uint64)
    padded = np.concatenate([coded, np.zeros(240, np.uint32)])
    for choice, (count, width) in enumerate(LAYOUTS):
        here = np.flatnonzero(chosen == choice)
        if width and len(here):
            for lane in range(count):
                words[here] |= padded[starts[here] + lane].astype(np.uint64) << np.uint64(4 + lane * width)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block: all words of one layout are read at once."""
    words = np.asarray(words, np.uint64)
    chosen = (words & np.uint64(15)).astype(np.int64)
    counts = np.array([count for count, _ in LAYOUTS])[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) if len(words) else 0, np.uint64)
    for choice, (count, width) in enumerate(LAYOUTS):
        here = np.flatnonzero(chosen == choice)
        if width and len(here):
            mask = np.uint64((1 << width) - 1)
            for lane in range(count):
                out[starts[here] + lane] = (words[here] >> np.uint64(4 + lane * width)) & mask
    out = out[:n]
    if len(escapes):
        out[out == ESCAPE] = np.asarray(escapes, np.uint64)
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids by word, as little-endian 32-bit integers. Missing words go to the tokenizer.

    The vocabulary splits at white space whatever stands beside it, so a text's ids are those of its
    words one after the other. So does a letter before a run of ``MARKS``. Words of letters in normal
    form and lower case need nothing but the tokenizer's model: ``plain`` encodes many in one call, where
    the last id of each word, and no other, is marked as the end of a word.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        size = self.tokenizer.get_vocab_size()
        names = (self.tokenizer.id_to_token(token) or "" for token in range(size))
        self.ends = np.array([name.endswith("</w>") for name in names])
        self.pending: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.pending.append(word)

    def ids_of(self, word: bytes) -> bytes:
        known = self[word]
        if known is None:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            known = self[word] = np.array(ids, "<u4").tobytes()
        return known

    def learn(self) -> None:
        """Take up the words that were asked for in vain."""
        words, parts, order = set(self.pending), {}, []
        for word in words:
            if word.isalpha() and word.islower():  # ASCII letters
                order.append(word)
                continue
            base = word.rstrip(MARKS)
            if base.isalpha():
                lower = base.lower()
            else:
                text = "".join(map(str.lower, base.decode()))
                if not text.isalpha() or not is_normalized("NFC", text):
                    continue
                lower = text.encode()
                if lower == word:
                    order.append(word)
                    continue
            parts[word] = lower, word[len(base) :]
        order += {lower for lower, _ in parts.values() if lower not in words and lower not in self}
        ids = self.plain.encode_batch_fast([b" ".join(order).decode()], add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(order):
            raw, at = ids.tobytes(), 0
            for word, end in zip(order, (4 * ends).tolist()):
                self[word] = raw[at:end]
                at = end
        for word, (lower, tail) in parts.items():
            self[word] = self.ids_of(lower) + self.ids_of(tail) if tail else self.ids_of(lower)
        for word in words:
            if word not in self:
                self.ids_of(word)
        self.pending = []


def _words(path: str) -> _Words:
    return held(f"words {path}", lambda: _Words(path))


def token_ids(texts: list[str | None], words: _Words, end_id: int) -> list[bytes]:
    """The ids of each text with the end id, as little-endian 32-bit integers.

    bytes.split() parts at the six ASCII white space characters alone, which never occur inside others.
    """
    if len(words) >= REMEMBERED:
        words.clear()
    split = [(text or "").encode().split() for text in texts]
    found = [list(map(words.__getitem__, parts)) for parts in split]
    end = np.array([end_id], "<u4").tobytes()
    if words.pending:
        asked = words.pending
        words.learn()
        fill = map(words.__getitem__, asked)  # in the order in which they were missing
        found = [[next(fill) if ids is None else ids for ids in own] for own in found]
    return [b"".join(own) + end for own in found]


def write_tokens(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text and write the blocks below ``path`` in ascending order of ``key``.

    Rows are dealt by ranges of key, text hash and input place, so that rows sharing one key spread
    over several parts. Every task writes one part through Spark's committed output.
    """
    tokenizer = tokenizer or default_tokenizer()
    kept = df.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = kept.repartitionByRange("key", "tie", "place").sortWithinPartitions("key", "tie", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = _words(tokenizer), TaskContext.get().partitionId()
        block = first = 0
        keys: list[int | None] = []
        lengths: list[int] = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal block, first, keys, lengths, ids, held
            packed, escapes = pack(np.frombuffer(b"".join(ids), "<u4"))
            row = [
                [part], [block], [first], [keys], [lengths], [packed.astype("<u8").tobytes()],
                [escapes.astype(np.int64).tolist()],
            ]
            kinds = [
                pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                pa.binary(), pa.list_(pa.int64()),
            ]
            block, first = block + 1, first + held
            keys, lengths, ids, held = [], [], [], 0
            names = ["part", "block", "first_token", "keys", "lengths", "words", "escapes"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            contents = batch.column(1)
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = contents.slice(at, TEXTS_AT_ONCE).to_pylist()
                for each, own in zip(
                    batch.column(0).slice(at, TEXTS_AT_ONCE).to_pylist(), token_ids(texts, words, end_id)
                ):
                    n = len(own) // 4
                    if held and held + n > block_ids:
                        yield close()
                    keys.append(each)
                    lengths.append(n)
                    ids.append(own)
                    held += n
        if keys:
            yield close()

    blocks = map_batches(ordered, run, BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)


def _part_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each part: one row a part, as many as tasks that wrote."""
    totals = blocks.select(
        "part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    totals = totals.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def read_documents(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """One row a document: ``key, start, n_tokens, ids_crc32`` and, unless only digests are wanted, ``ids``."""
    blocks = spark.read.parquet(path)
    starts = _part_starts(blocks)
    placed = blocks.join(F.broadcast(starts) if is_small(starts) else starts, "part")
    schema = "key long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = unpack(np.frombuffer(row["words"], "<u8"), row["escapes"], int(ends[-1]))
                raw = ids.astype("<u4").tobytes()
                starts = (ends - lengths).tolist()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends.tolist())]
                start = row["part_start"] + row["first_token"] + ends - lengths
                columns = [
                    pa.array(row["keys"], pa.int64()), pa.array(start, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(crc, pa.int64()),
                ]
                if not digest_only:
                    parts = [ids[a:b].astype(np.int64) for a, b in zip(starts, ends.tolist())]
                    columns.append(pa.array(parts, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(placed, run, schema)
