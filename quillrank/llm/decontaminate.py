"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND, then overlap.

The items are indexed, every passage of every training text is a query. A term's impact on an item is
its BM25 share of the item's own full score, so a passage that holds all of an item's terms scores 1.
Blocks of items whose highest impacts cannot sum to ``THRESHOLD`` are skipped; in the others WAND walks the
postings in item order, from one pivot that can reach it to the next. All items at or above it are retrieved. A retrieved item counts if
the passage holds enough word n-grams of its question and of its answer; of short ones, all words but one in order do too.
A benchmark row without separate answer is verified as one whole.

Passages are windows of three times as many words as the longest item has, twice as many words apart, so
that any item's text fits one window whole; nothing is cut or skipped.

Defined results: texts or items that are null, empty or without words match nothing; repeated items match
each for themselves; repeated rows give repeated results; ties need no order, as all matches are returned; further
columns are kept by ``clean`` and left by ``matches``; empty tables give no matches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import give_back, held, map_batches
from quillrank.operators.grouping import measured_bytes

K1, B = 1.2, 0.75
#: Share of an item's full score that a passage must reach.
THRESHOLD = 0.5
#: Shares of the question's and the answer's n-grams that a passage must hold.
QUESTION, ANSWER = 0.6, 0.5
NGRAM = 5
#: Parts of fewer words are also verified by their words in order.
SHORT = 4 * NGRAM
#: Parts of this many words may lie in a slightly longer stretch.
LOOSE = 8
#: Words of an answer one of which may differ; of a question, ``NGRAM``.
LEAST_ANSWER = 3
#: Items of a block.
BLOCK = 4
#: Rounding error allowed for in comparing sums of impacts with the threshold.
SLACK = 1e-9
#: Bytes of items that are indexed and broadcast at once; larger item tables are searched in such blocks.
INDEX_BYTES = 16 * 1024 * 1024
REMEMBERED = 200_000
NO_TERM = (-1,)
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class Item:
    key: object
    question: list[str]
    answer: list[str]


@dataclass
class Postings:
    """Items of a term in order with its impacts; highest impact by block of item numbers."""

    items: list[int]
    impacts: list[float]
    blocks: np.ndarray
    highest: np.ndarray


@dataclass
class Index:
    """Postings by term number, for one part of the items with the statistics of all.

    Items are numbered by length, so that those of a block give alike impacts and its bounds are tight.
    """

    terms: dict[str, int]
    postings: list[Postings]
    items: list[Item]
    step: int

    def search(self, terms: set[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All items whose impacts sum to the threshold or more, with their sums.

        Only blocks whose highest impacts sum to the threshold are entered, each by WAND.
        """
        if not terms:
            return []
        lists = [self.postings[t] for t in terms]
        bounds = np.bincount(
            np.concatenate([own.blocks for own in lists]), np.concatenate([own.highest for own in lists])
        )
        return [
            hit
            for block in np.flatnonzero(bounds >= threshold - SLACK).tolist()
            for hit in _search_block(lists, block, threshold)
        ]


def _search_block(lists: list[Postings], block: int, threshold: float) -> Iterator[tuple[int, float]]:
    end = (block + 1) * BLOCK
    cursors = []  # [current item, place, postings, highest impact in this block]
    for own in lists:
        at = bisect_left(own.items, block * BLOCK)
        if at < len(own.items) and own.items[at] < end:
            cursors.append([own.items[at], at, own, float(own.highest[bisect_left(own.blocks, block)])])
    while cursors:
        cursors.sort(key=_current)
        bound, pivot = 0.0, -1
        for at, cursor in enumerate(cursors):
            bound += cursor[3]
            if bound >= threshold - SLACK:
                pivot = at
                break
        if pivot < 0:
            return
        item = cursors[pivot][0]
        if cursors[0][0] == item:
            score = sum(own.impacts[at] for current, at, own, _ in cursors if current == item)
            if score >= threshold - SLACK:
                yield item, score
            item += 1
        for cursor in cursors:
            if cursor[0] >= item:
                break
            items = cursor[2].items
            cursor[1] = bisect_left(items, item, cursor[1])
            cursor[0] = items[cursor[1]] if cursor[1] < len(items) else end
        cursors = [cursor for cursor in cursors if cursor[0] < end]


def _current(cursor: list) -> int:
    return cursor[0]


def build_index(rows: list[tuple[object, str, str | None]], n: int, mean: float, df: dict[str, int], step: int) -> Index:
    """``rows`` are (key, question or whole text, answer or None); ``n``, ``mean``, ``df`` are of all items."""
    items = []
    for key, question, answer in rows:
        items.append(Item(key, words_of(question), words_of(answer)))
    items.sort(key=lambda item: len(item.question) + len(item.answer))
    terms: dict[str, int] = {}
    lists: list[list[tuple[int, float]]] = []
    for number, item in enumerate(items):
        counted = Counter(item.question + item.answer)
        length = K1 * (1 - B + B * counted.total() / mean)
        parts = {
            word: math.log(1 + (n - df[word] + 0.5) / (df[word] + 0.5)) * tf * (K1 + 1) / (tf + length)
            for word, tf in counted.items()
        }
        whole = sum(parts.values())
        for word, part in parts.items():
            at = terms.setdefault(word, len(lists))
            if at == len(lists):
                lists.append([])
            lists[at].append((number, part / whole))
    postings = []
    for each in lists:
        highest: dict[int, float] = {}
        for number, impact in each:
            highest[number // BLOCK] = max(impact, highest.get(number // BLOCK, 0.0))
        postings.append(
            Postings(
                [number for number, _ in each], [impact for _, impact in each],
                np.array(list(highest), np.int64), np.array(list(highest.values())),
            )
        )
    return Index(terms, postings, items, step)


def index_blocks(items: DataFrame, key: str, question: str, answer: str | None = None) -> Iterator[Index]:
    """Indexes of bounded size that together hold all items. Statistics come from one Spark pass over all."""
    empty = F.lit(None).cast("string")
    kept = items.select(
        F.col(key).alias("key"), F.col(question).alias("question"), (F.col(answer) if answer else empty).alias("answer")
    )
    kept = kept.where(F.col("question").isNotNull())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([words_of(q) + words_of(a) for q, a in both], pa.list_(pa.string()))], ["words"])

    words = map_batches(kept.select("question", "answer"), split, "words array<string>").where(F.size("words") > 0)
    sizes = words.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"), F.max(F.size("words")).alias("longest")
    ).first()
    if not sizes["n"]:
        return
    frequencies = words.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df")
    )
    blocks = max(1, math.ceil(measured_bytes(kept) / INDEX_BYTES))
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("key", "question"), F.lit(blocks)))
    for block in range(blocks):
        rows = [(r["key"], r["question"], r["answer"]) for r in dealt.where(F.col("block") == block).collect()]
        rows = [row for row in rows if words_of(row[1]) or words_of(row[2])]
        if not rows:
            continue
        own = items.sparkSession.createDataFrame(
            [(word,) for word in sorted({w for _, q, a in rows for w in words_of(q) + words_of(a)})], "word string"
        )
        df = {r["word"]: r["df"] for r in frequencies.join(own, "word").collect()}
        yield build_index(rows, sizes["n"], sizes["mean"], df, max(16, sizes["longest"]))


def _share(part: list[str], passage: list[str], n: int) -> float:
    """Share of the n-grams of ``part`` (all of it, if shorter) that the passage holds; 1 if it is empty."""
    if not part:
        return 1.0
    n = min(n, len(part))
    held = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    wanted = [tuple(part[i : i + n]) for i in range(len(part) - n + 1)]
    return sum(gram in held for gram in wanted) / len(wanted)


def _ordered(part: list[str], passage: list[str]) -> float:
    """Share of the words of ``part`` that a stretch of the passage about as long holds in the same order."""
    n = len(part)
    places: dict[str, int] = {}
    for i, word in enumerate(part):
        places[word] = places.get(word, 0) | 1 << i
    own = [places.get(word, 0) for word in passage]
    width = n + (max(1, n // NGRAM) if n >= LOOSE else 0)
    seen = [0, *accumulate(map(bool, own))]
    best, whole = 0, (1 << n) - 1
    for start, bits in enumerate(own):
        if not bits or seen[min(len(own), start + width)] - seen[start] <= best:
            continue
        row = whole  # bit-parallel longest common subsequence; its zeros are the words met
        for each in own[start : start + width]:
            met = row & each
            row = ((row + met) | (row - met)) & whole
        best = max(best, n - row.bit_count())
    return best / n


def _held_share(part: list[str], passage: list[str], least: int = NGRAM) -> float:
    """Share of the part's n-grams that the passage holds, or of its words if all but one stand there in order.

    One changed word takes ``NGRAM`` n-grams, too much of a short part; a part of ``SHORT`` words keeps enough of them.
    Parts of fewer than ``least`` words must be there as they are, as a word less says too little.
    """
    share = _share(part, passage, NGRAM)
    if share < 1.0 and least <= len(part) < SHORT:
        ordered = _ordered(part, passage)
        if ordered * len(part) > len(part) - 1.5:
            return max(share, ordered)
    return share


class _Words(dict):
    """Term numbers of the words in each stretch without white space, -1 for a word outside the index."""

    def __init__(self, index: Index) -> None:
        super().__init__()
        self.terms = index.terms

    def __missing__(self, raw: bytes) -> tuple[int, ...]:
        word = raw.decode().lower()
        if word.isalnum():  # the usual case: one word and nothing else
            found = (self.terms[word],) if word in self.terms else NO_TERM
        else:
            found = tuple(self.terms.get(own, -1) for own in words_of(word))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(raw) <= 64:
            self[raw] = found
        return found


def text_matches(text: str | None, index: Index, words: _Words) -> dict[int, tuple[float, float, float]]:
    """Items that the text holds: number -> (score, question share, answer share) of the best passage."""
    ids = list(chain.from_iterable(map(words.__getitem__, (text or "").encode().split())))
    out: dict[int, tuple[float, float, float]] = {}
    spelled: list[str] | None = None
    for start in range(0, max(1, len(ids) - index.step), 2 * index.step):
        terms = set(ids[start : start + 3 * index.step])
        terms.discard(-1)
        for number, score in index.search(terms):
            if spelled is None:
                spelled = words_of(text)
            passage = spelled[start : start + 3 * index.step]
            item = index.items[number]
            asked, replied = _held_share(item.question, passage), _held_share(item.answer, passage, LEAST_ANSWER)
            if asked >= QUESTION and replied >= ANSWER and (score, asked, replied) > out.get(number, (0.0, 0.0, 0.0)):
                out[number] = (score, asked, replied)
    return out


def _worker_words(name: str, index: Index) -> _Words:
    return held(name, lambda: _Words(index))


def _shared(df: DataFrame, index: Index):
    shared = df.sparkSession.sparkContext.broadcast(index)
    return shared, f"index-{shared._jbroadcast.id()}-{df.sparkSession.sparkContext.applicationId}"


def matches(
    df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    question: str = "text", answer: str | None = None,
) -> DataFrame:
    """``key, item``, best ``score``, ``question_share`` and ``answer_share`` of every match."""
    kept = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = kept.schema["key"].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"key {kinds[0]}, item {kinds[1]}, score double, question_share double, answer_share double"
    names = [part.split()[0] for part in schema.split(", ")]
    found = None
    for index in index_blocks(items, item, question, answer):
        shared, name = _shared(df, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            words = _worker_words(name, shared.value)
            for batch in batches:
                kind = batch.schema.field(0).type
                rows = [
                    (own, shared.value.items[number].key, *values)
                    for own, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for number, values in text_matches(content, shared.value, words).items()
                ]
                if not rows:
                    continue
                columns = list(zip(*rows))
                types = [kind, None, pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        part = map_batches(kept, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], schema)
    return found.withColumnsRenamed({"key": key, "item": item})


def clean(
    df: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", question: str = "text", answer: str | None = None
) -> DataFrame:
    """The rows of ``df`` that match no item; one pass per block of items, without a shuffle."""
    for index in index_blocks(items, item, question, answer):
        shared, name = _shared(df, index)
        place = df.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name, place=place) -> Iterator[pa.RecordBatch]:
            words = _worker_words(name, shared.value)
            for batch in batches:
                keep = [not text_matches(content, shared.value, words) for content in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))
            give_back(name)

        df = map_batches(df, run, df.schema)
    return df
