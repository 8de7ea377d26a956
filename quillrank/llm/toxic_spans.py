"""Toxic spans by a linear-chain conditional random field over words.

Labelled tokens come from labelled texts: a word of a toxic text is a toxic token if one of its features
(the word, its first three to six letters) stands in enough toxic and hardly any clean texts. These
counts cover every labelled text, near copies as one. The field is fitted by gradient ascent on a bounded sample of texts
with their token labels; forward-backward gives each word's marginal. Words with a marginal of one half
or more form the offending spans. The score of a text is the chance that at least one of the words with a
marginal of ``COUNTED`` or more is toxic, or the largest marginal if no word reaches that.

Defined results: a null or empty text, or one without letters, scores 0 and has no spans; without any
toxic or any clean training text all scores are 0; texts are never cut; rows are independent, so repeated
rows and further columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import hash_limit, held, map_batches
from quillrank.session import materialise

#: About so many texts of each label are fitted on: those in the lowest share of text hashes that is expected
#: to hold that number.
TRAINING_TEXTS = 1_200
#: A feature marks toxic tokens if it is in so many toxic texts at least, as a share and a number ...
MIN_SHARE, MIN_TEXTS = 0.002, 5
#: ... and if so large a share of the texts that hold it are toxic, both labels weighing the same and
#: one clean text added, so that a few chance hits do not do.
PURITY = 0.98
#: Near copies count as one text: those that share one of so many smallest hashes of word n-grams.
SKETCHES, NGRAM = 6, 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.array([crc32(b"%d" % i) << 32 | crc32(b"salt %d" % i) for i in range(SKETCHES)], np.uint64)
#: The field is fitted on stretches of so many words; every word of a training text is in one.
STRETCH = 256
PREFIXES = (3, 4, 5, 6)
BUCKETS = 1 << 18
COUNTED = 0.1
REMEMBERED = 500_000
TOGETHER = 4096
ROUNDS, RATE, DECAY = 40, 0.5, 1e-3
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


def buckets(word: str) -> list[int]:
    return [crc32(feature.encode()) % BUCKETS for feature in features(word)]


@dataclass
class ToxicField:
    """Weight of each feature bucket for "toxic", a bias, and scores of label changes."""

    weights: np.ndarray
    bias: float
    changes: np.ndarray

    def score(self, word: str) -> float:
        return self.bias + float(self.weights[buckets(word)].sum())


def _steps(lengths: np.ndarray) -> np.ndarray:
    """How many texts, sorted by falling length, have a word at each step."""
    return np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, changes: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "toxic" for words laid end to end, and expected counts of label pairs.

    ``lengths`` must fall. All texts go forwards, then backwards, together; each step is normalised.
    """
    starts = np.cumsum(lengths) - lengths
    going = _steps(lengths)
    top = np.maximum(scores, 0.0)
    emit = np.stack([np.exp(-top), np.exp(scores - top)], 1)
    moves = np.exp(changes)
    ahead = np.empty_like(emit)
    for step, n in enumerate(going):
        at = starts[:n] + step
        here = emit[at] if step == 0 else (ahead[at - 1] @ moves) * emit[at]
        ahead[at] = here / here.sum(1, keepdims=True)
    marginals, counts = np.empty(len(scores)), np.zeros((2, 2))
    behind = np.ones((len(lengths), 2))
    for step in range(len(going) - 1, -1, -1):
        n = going[step]
        at = starts[:n] + step
        both = ahead[at] * behind[:n]
        marginals[at] = both[:, 1] / both.sum(1)
        weighted = emit[at] * behind[:n]
        if step:
            if pairs:
                joint = ahead[at - 1][:, :, None] * moves[None] * weighted[:, None, :]
                counts += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            back = weighted @ moves.T
            behind[:n] = back / back.sum(1, keepdims=True)
    return marginals, counts


def fit_field(texts: list[list[str]], labels: list[np.ndarray], rounds: int = ROUNDS) -> ToxicField:
    """Gradient ascent, with rates that shrink by each weight's past gradients, on labelled words."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    known: dict[str, int] = {}
    words = np.fromiter((known.setdefault(w, len(known)) for i in order for w in texts[i]), np.int64)
    marks = np.concatenate([labels[i] for i in order]).astype(float)
    owned = [buckets(word) for word in known]
    of_word = np.repeat(np.arange(len(owned)), [len(own) for own in owned])
    bucket = np.fromiter((b for own in owned for b in own), np.int64)
    seen = np.zeros((2, 2))
    inside = np.ones(len(words), bool)
    inside[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(inside)
    np.add.at(seen, (marks[at - 1].astype(int), marks[at].astype(int)), 1)
    weights, bias, changes = np.zeros(BUCKETS), -4.0, np.zeros((2, 2))
    past, past_bias, past_changes = np.full(BUCKETS, 1e-2), 1.0, np.full((2, 2), 1.0)
    for _ in range(rounds):
        scores = bias + np.bincount(of_word, weights[bucket], len(owned))[words]
        marginals, expected = forward_backward(scores, lengths, changes, pairs=True)
        slope = np.bincount(words, marks - marginals, len(owned))
        gradient = np.bincount(bucket, slope[of_word], BUCKETS) - DECAY * weights
        past += gradient**2
        weights += RATE * gradient / np.sqrt(past)
        slope_bias, slope_changes = slope.sum(), seen - expected - DECAY * changes
        past_bias, past_changes = past_bias + slope_bias**2, past_changes + slope_changes**2
        bias += RATE * slope_bias / past_bias**0.5
        changes = changes + RATE * slope_changes / np.sqrt(past_changes)
    return ToxicField(weights.astype(np.float32), float(bias), changes)


def sketch(words: list[str], known: dict[str, int]) -> list[int]:
    """Smallest hashes of the text's word n-grams under ``SKETCHES`` hash functions; near copies share some."""
    if len(known) >= REMEMBERED:
        known.clear()
    ids = []
    for word in words:
        at = known.get(word)
        if at is None:
            at = known[word] = crc32(word.encode())
        ids.append(at)
    n = max(1, min(NGRAM, len(ids)))
    hashed = np.array(ids or [0], np.uint64)
    grams = np.zeros(len(hashed) - n + 1, np.uint64)
    for i in range(n):
        grams = (grams * _MIX + hashed[i : i + len(grams)]) * _MIX
        grams ^= grams >> np.uint64(29)
    mixed = (grams[:, None] ^ _SALTS) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return (mixed * _MIX).min(0).view(np.int64).tolist()


def one_a_class(rows: DataFrame) -> DataFrame:
    """``rows(text, toxic)`` with one text of each class of near copies of a label.

    Of the texts that share one of the sketch's hashes the one with the smallest digest stays, hash by hash.
    Each step adds up by key, so that a huge class does not meet in one task.
    """
    rows = rows.withColumn("digest", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            made = [sketch(WORDS.findall(text.lower()), known) for text in batch.column(2).to_pylist()]
            columns = [pa.array([each[i] for each in made], pa.int64()) for i in range(SKETCHES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    names = ["digest", "toxic", *[f"h{i}" for i in range(SKETCHES)]]
    schema = ", ".join(["digest long", "toxic boolean", *[f"{name} long" for name in names[2:]]])
    kept = map_batches(rows.select("digest", "toxic", "text"), run, schema)
    for i in range(SKETCHES):
        first = F.min(F.struct(*[name for name in names if name not in ("toxic", f"h{i}")])).alias("first")
        kept = kept.groupBy("toxic", f"h{i}").agg(first).select("toxic", f"h{i}", "first.*")
    return rows.join(kept.select("digest", "toxic"), ["digest", "toxic"], "left_semi").select("text", "toxic")


def token_marks(labelled: DataFrame, text: str, toxic: str) -> set[str]:
    """Features that mark toxic tokens, counted over all labelled texts.

    Texts are counted on both sides, near copies of a label as one, so that the words of a text with many
    near copies do not pass for toxic and the rule is the same for any number of texts. Each task counts its
    own texts first. At most ``features of a text / MIN_SHARE`` reach the driver.
    """
    rows = labelled.select(F.col(text).alias("text"), (F.col(toxic) == 1).alias("toxic"))
    rows = materialise(one_a_class(rows), "text-classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for content, bad in zip(*(column.to_pylist() for column in batch.columns)):
                for feature in {f for word in set(WORDS.findall(content.lower())) for f in features(word)}:
                    counts.setdefault(feature, [0, 0])[bad] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts, pa.string()), pa.array([n for n, _ in counts.values()], pa.int64()),
                 pa.array([n for _, n in counts.values()], pa.int64())],
                ["feature", "clean", "toxic"],
            )

    sizes = {bool(r["toxic"]): r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, bad = sizes.get(False, 0), sizes.get(True, 0)
    if not clean or not bad:
        return set()
    counted = (
        map_batches(rows, run, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= max(MIN_TEXTS, MIN_SHARE * bad))
        .where(F.col("toxic") / bad >= PURITY * (F.col("toxic") / bad + (F.col("clean") + 1) / clean))
    )
    return {row["feature"] for row in counted.select("feature").collect()}


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", texts: int = TRAINING_TEXTS) -> ToxicField | None:
    """Fit on rows of ``text`` and ``toxic`` (0 or 1; rows with a null in either are left out)."""
    usable = labelled.where(F.col(text).isNotNull() & F.col(toxic).isNotNull())
    usable = usable.select(text, toxic, F.xxhash64(text).alias("digest")).dropDuplicates(["digest", toxic])
    usable = materialise(usable, "labelled-texts")
    marks = token_marks(usable, text, toxic)
    if not marks:
        return None
    contents: list[list[str]] = []
    labels: list[np.ndarray] = []
    sizes = {r[toxic]: r["n"] for r in usable.groupBy(toxic).agg(F.count(F.lit(1)).alias("n")).collect()}
    for label in (1, 0):
        # the share of all hashes that is expected to hold so many texts; nothing is sorted or gathered
        limit = hash_limit(texts, sizes.get(label, 0))
        sample = usable.where((F.col(toxic) == label) & (F.col("digest") <= limit)).select(text)
        for row in sample.toLocalIterator():
            words = WORDS.findall(row[0].lower())
            for at in range(0, len(words), STRETCH):
                stretch = words[at : at + STRETCH]
                contents.append(stretch)
                hits = [bool(label) and not marks.isdisjoint(features(word)) for word in stretch]
                labels.append(np.array(hits, bool))
    return fit_field(contents, labels)


class _Words(dict):
    def __init__(self, field: ToxicField) -> None:
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        score = self[word] = self.field.score(word)
        return score


def text_score(marginals: np.ndarray) -> float:
    if not len(marginals):
        return 0.0
    counted = marginals[marginals >= COUNTED]
    return float(1.0 - np.prod(1.0 - counted)) if len(counted) else float(marginals.max())


def tag_texts(texts: list[str | None], table: _Words) -> list[tuple[float, list[tuple[int, int]]]]:
    """Score and spans of each text, as first character and end."""
    rows = []
    for text in texts:
        words = WORDS.findall((text or "").lower())  # lower case changes no word's place in the order
        rows.append(np.fromiter(map(table.__getitem__, words), float, len(words)))
    order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: -len(rows[i]))
    out: list[tuple[float, list[tuple[int, int]]]] = [(0.0, [])] * len(texts)
    if not order:
        return out
    lengths = np.array([len(rows[i]) for i in order])
    marginals, _ = forward_backward(np.concatenate([rows[i] for i in order]), lengths, table.field.changes)
    ends = np.cumsum(lengths)
    for i, end, length in zip(order, ends.tolist(), lengths.tolist()):
        own = marginals[end - length : end]
        spans: list[tuple[int, int]] = []
        if own.max() >= 0.5:
            places = [match.span() for match in WORDS.finditer(texts[i])]
            before = -2
            for k in np.flatnonzero(own >= 0.5).tolist():
                if k == before + 1:
                    spans[-1] = spans[-1][0], places[k][1]
                else:
                    spans.append(places[k])
                before = k
        out[i] = text_score(own), spans
    return out


def score_texts(df: DataFrame, field: ToxicField | None, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``score`` and ``spans`` (first character and end)."""
    shared = df.sparkSession.sparkContext.broadcast(field)  # of fixed size
    name = f"field-{shared._jbroadcast.id()}-{df.sparkSession.sparkContext.applicationId}"
    others = [column for column in df.columns if column not in (text, "score", "spans")]
    kept = df.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{column}`") for column in others])
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]]
        + ["score double", "spans array<struct<first: int, end: int>>"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            if shared.value is None:
                results = [(0.0, [])] * batch.num_rows
            else:
                results = []
                for at in range(0, batch.num_rows, TOGETHER):
                    results += tag_texts(batch.column(0).slice(at, TOGETHER).to_pylist(), held(name, lambda: _Words(shared.value)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([r[0] for r in results], pa.float64()),
                 pa.array([[{"first": a, "end": b} for a, b in r[1]] for r in results], kind)],
                [*others, "score", "spans"],
            )

    return map_batches(kept, run, schema)
