"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed texts.

A word is a maximal run of letters and marks. Its letters' scripts leave as candidates the languages
that the training texts write in such a script; all languages stay if none do. Each candidate has a
log probability from character n-grams of the word, and Viterbi finds the best sequence of languages
where each change costs ``SWITCH``. The text's language is the one whose spans hold most letters, its
score their share of all letters times the mean certainty of those words.

Learned from a sample of labelled texts: per language, those in the lowest share of text hashes that is
expected to hold ``TRAINING_TEXTS`` distinct texts, which bounds the model for any input size.

Defined results: a text that is null or has no letters has language ``und``, score 0 and no spans; ties
go to the language first in alphabetical order; texts are never cut; rows are independent, so repeated
rows and further columns do not matter; an empty table gives an empty table. Without any labelled text
every text with letters is ``und``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import give_back, hash_limit, held, map_batches

UNKNOWN = "und"
TRAINING_TEXTS = 1_000
NGRAMS = (1, 2, 3, 4)
#: Cost of a change of language, in the unit of the words' log probabilities.
SWITCH = 6.0
#: Word scores that a Python worker remembers; beyond it the memory is emptied.
REMEMBERED = 400_000
#: New words whose n-grams are looked up and summed together.
SCORED_TOGETHER = 4096
#: Texts that Viterbi walks through together.
TOGETHER = 512
#: Rounding error allowed for in comparing scores.
SLACK = 1e-3

# First and last code point of the main blocks of scripts.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)),
}
WORDS = regex.compile(r"(?<![\p{L}\p{M}])\p{M}*+\p{L}[\p{L}\p{M}]*+")


@lru_cache(maxsize=1 << 16)
def script_of(letter: str) -> str | None:
    code = ord(letter)
    for name, blocks in SCRIPTS.items():
        if any(first <= code <= last for first, last in blocks):
            return name
    return None


def scripts_of(word: str) -> set[str]:
    found = set(map(script_of, word))
    found.discard(None)
    return found


def word_ngrams(word: str) -> list[str]:
    framed = f"^{word}$"
    return [framed[i : i + n] for n in NGRAMS for i in range(len(framed) - n + 1)]


@dataclass
class LanguageModel:
    """Row of each n-gram in ``weights``, its log probabilities by language, and each script's languages.

    The first rows are those of unseen n-grams, by length.
    """

    languages: list[str]
    rows: dict[str, int]
    weights: np.ndarray
    script_languages: dict[str, list[int]]

    def candidates(self, word: str) -> list[int]:
        allowed = {i for script in scripts_of(word) for i in self.script_languages.get(script, ())}
        return sorted(allowed) or list(range(len(self.languages)))

    def score(self, word: str) -> np.ndarray:
        """Log posterior of the languages given the lower-case word alone; minus infinity if not a candidate."""
        return self.scores([word])[0]

    def scores(self, words: list[str]) -> np.ndarray:
        """``score`` of each word, all at once."""
        framed = [f"^{word}$" for word in words]
        numbers, tables = self._ngrams
        codes = numbers[np.frombuffer("".join(framed).encode("utf-32-le"), np.uint32)]
        lengths = np.array([len(word) for word in framed])
        starts = np.cumsum(lengths) - lengths
        left = np.repeat(starts + lengths, lengths) - np.arange(len(codes))  # characters from here to the word's end
        total = np.zeros((len(codes), len(self.languages)))
        keys = np.zeros(len(codes), np.uint64)
        for n in NGRAMS:
            if n <= len(codes):
                # a key has 16 bits a character; n-grams that reach beyond the word count as row 0, which is zero
                keys = (keys[: len(codes) - n + 1] << np.uint64(16)) | codes[n - 1 :]
                known, rows = tables[n]
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = np.where(known[at] == keys, rows[at], n)
                total[: len(keys)] += self.weights[np.where(left[: len(keys)] >= n, found, 0)]
        total = np.add.reduceat(total, starts, axis=0) / len(NGRAMS)
        barred: dict[tuple[int, ...], list[int]] = {}  # places of the words with these candidates only
        latin = tuple(self.candidates("a"))
        for place, word in enumerate(words):
            barred.setdefault(latin if word.isascii() else tuple(self.candidates(word)), []).append(place)
        for allowed, places in barred.items():
            others = [i for i in range(len(self.languages)) if i not in allowed]
            if others:
                total[np.ix_(places, others)] = -np.inf
        total -= total.max(1, keepdims=True)
        return total - np.log(np.exp(total).sum(1, keepdims=True))

    @cached_property
    def _ngrams(self) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Number of each code point, 0 for one not seen in training, and sorted keys with rows by n-gram length."""
        seen = sorted({letter for gram in self.rows if len(gram) == 1 for letter in gram})
        if len(seen) >= 1 << 16:
            raise ValueError(f"{len(seen)} letters in the training texts, at most 65,535 fit a key")
        numbers = np.zeros(0x110000, np.uint64)
        for number, letter in enumerate(seen, 1):
            numbers[ord(letter)] = number
        tables = {}
        for n in NGRAMS:
            grams = [gram for gram in self.rows if len(gram) == n]
            letters = np.array([[numbers[ord(letter)] for letter in gram] for gram in grams], np.uint64).reshape(-1, n)
            keys = np.zeros(len(grams), np.uint64)
            for column in letters.T:
                keys = (keys << np.uint64(16)) | column
            order = np.argsort(keys)
            rows = np.array([self.rows[gram] for gram in grams], np.int64)[order]
            # the last key stands for none, so that a table is never empty
            tables[n] = np.append(keys[order], np.uint64(2**64 - 1)), np.append(rows, n)
        return numbers, tables


def fit(df: DataFrame, text: str = "text", language: str = "lang", texts: int = TRAINING_TEXTS) -> LanguageModel:
    """Count n-grams of the sample of each language in Spark; only n-grams by language reach the driver.

    The number of those is bounded by the sample. Counts are of distinct words, so that no repeated
    text or word outweighs the rest.
    """
    labelled = df.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("digest")
    )
    # the share of all hashes that is expected to hold so many distinct texts; nothing is sorted or gathered
    counts = labelled.select("lang", "digest").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    within = F.lit(False)
    for row in counts:  # one row a language
        within = within | ((F.col("lang") == row["lang"]) & (F.col("digest") <= hash_limit(texts, row["n"])))
    sample = labelled.where(within).dropDuplicates(["lang", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str]] = []
            for lang, content in zip(*(column.to_pylist() for column in batch.columns)):
                rows += [(lang, word) for word in set(WORDS.findall(content.lower()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, _ in rows], pa.string()), pa.array([word for _, word in rows], pa.string())],
                ["lang", "word"],
            )

    words = map_batches(sample.select("lang", "text"), run, "lang string, word string")
    counted: dict[str, Counter] = {}
    for lang, word, n in words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        weight = 1.0 + math.log(n)
        grams = counted.setdefault(lang, Counter())
        for gram in word_ngrams(word):
            grams[gram] += weight
    languages = sorted(counted)
    totals = {n: np.zeros(len(languages)) for n in NGRAMS}
    kinds: Counter = Counter()
    table: dict[str, np.ndarray] = {}
    scripts: dict[str, set[int]] = {}
    for i, lang in enumerate(languages):
        letters: Counter = Counter()
        for gram, n in counted[lang].items():
            table.setdefault(gram, np.zeros(len(languages)))[i] = n
            totals[len(gram)][i] += n
            if len(gram) == 1:
                for script in scripts_of(gram):
                    letters[script] += n
        for script, n in letters.items():
            if n >= 0.01 * sum(letters.values()):
                scripts.setdefault(script, set()).add(i)
    for gram in table:
        kinds[len(gram)] += 1
    smooth = 0.5
    bases = {n: np.log(totals[n] + smooth * (kinds[n] + 1)) for n in NGRAMS}
    # what no language has seen says nothing about the language
    unseen = [0.0] + [float(np.mean(np.log(smooth) - bases[n])) if languages else 0.0 for n in range(1, max(NGRAMS) + 1)]
    weights = [np.full(len(languages), value) for value in unseen]
    weights += [np.log(counts + smooth) - bases[len(gram)] for gram, counts in table.items()]
    rows = {gram: len(unseen) + i for i, gram in enumerate(table)}
    return LanguageModel(languages, rows, np.array(weights), {name: sorted(ids) for name, ids in scripts.items()})


def certain(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Per row the language ahead of all others by more than two changes, else -1.

    The best sequence has that language there whatever stands around the word: putting it in adds two changes at most.
    """
    if scores.shape[1] == 1:
        return np.zeros(len(scores), np.int16)
    best = scores.argmax(1)
    top = np.partition(scores, -2, axis=1)[:, -2:]
    return np.where(top[:, 1] > top[:, 0] + 2 * switch + SLACK, best, -1).astype(np.int16)


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best language of each word of each text, given a (words, languages) array per text."""
    if not scores:
        return []
    ends = np.cumsum([len(own) for own in scores])
    labels = best_paths(np.concatenate(scores), ends - [len(own) for own in scores], switch)
    return np.split(labels, ends[:-1])


def best_paths(scores: np.ndarray, starts: np.ndarray, switch: float = SWITCH, sure: np.ndarray | None = None) -> np.ndarray:
    """The best language of each word, for several texts at once.

    ``scores`` has a row for each word, the texts one after the other; text i begins at ``starts[i]``. A text
    falls apart before each word whose language is ``certain`` (``sure``, if known), as no path takes another one there.
    All parts advance word by word together, the longest first, so that those still going are a prefix: a long
    text takes as many steps as its longest part.
    """
    words, states = scores.shape
    kind = np.int8 if states <= 127 else np.int32
    if not words:
        return np.zeros(0, kind)
    sure = certain(scores, switch) if sure is None else sure
    opens = sure >= 0
    opens[starts[starts < words]] = True
    first = np.flatnonzero(opens)
    lengths = np.diff(first, append=words)
    # the language that the next part of the same text begins with, or -1
    ends = np.append(sure[first[1:]], -1)
    text_starts = np.zeros(words, bool)
    text_starts[starts[starts < words]] = True
    ends[:-1][text_starts[first[1:]]] = -1

    order = np.argsort(-lengths, kind="stable")
    first, lengths, ends = first[order], lengths[order], ends[order]
    longest = int(lengths[0])
    going = np.searchsorted(-lengths, -np.arange(longest), side="left")  # parts with a word at each step
    best = scores[first].astype(np.float64)
    fixed = sure[first]
    known = np.flatnonzero(fixed >= 0)
    best[known] = -np.inf
    best[known, fixed[known]] = 0.0
    back: list[np.ndarray] = []
    for step in range(1, longest):
        n = going[step]
        before = best[:n]
        top = before.argmax(1)
        moved = before[np.arange(n), top] - switch
        stay = before >= moved[:, None]
        back.append(np.where(stay, np.arange(states)[None, :], top[:, None]).astype(kind))
        best[:n] = np.where(stay, before, moved[:, None]) + scores[first[:n] + step]
    top = best.argmax(1)
    every = np.arange(len(first))
    onward = np.where(best[every, ends] >= best[every, top] - switch, ends, top)
    current = np.where(ends >= 0, onward, top).astype(kind)
    labels = np.zeros(words, kind)
    for step in range(longest - 1, -1, -1):
        n = going[step]
        labels[first[:n] + step] = current[:n]
        if step:
            current[:n] = back[step - 1][np.arange(n), current[:n]]
    return labels


class _Words(dict):
    """Row of each word in the growing table of scores, letters and certain languages."""

    def __init__(self, model: LanguageModel, switch: float) -> None:
        super().__init__()
        self.model = model
        self.switch = switch
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1024, np.int32)
        self.sure = np.zeros(1024, np.int16)

    def rows(self, words: list[str]) -> np.ndarray:
        """The rows of the words; those not met before are scored together."""
        new = list(set(words).difference(self))
        if len(self) + len(new) > REMEMBERED and len(self):
            self.clear()
            new = list(set(words))
        while len(self) + len(new) > len(self.scores):
            for name in ("scores", "letters", "sure"):
                held_now = getattr(self, name)
                setattr(self, name, np.concatenate([held_now, np.zeros_like(held_now)]))
        for at in range(0, len(new), SCORED_TOGETHER):
            part = new[at : at + SCORED_TOGETHER]
            first = len(self)
            scores = self.model.scores(part).astype(np.float32)
            self.scores[first : first + len(part)] = scores
            self.letters[first : first + len(part)] = [len(word) for word in part]
            self.sure[first : first + len(part)] = certain(scores, self.switch)
            self.update(zip(part, range(first, first + len(part))))
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _word_table(model: LanguageModel, name: str, switch: float = SWITCH) -> _Words:
    """One table for each model and worker, kept from task to task; one that would outgrow its bound is emptied."""
    return held(name, lambda: _Words(model, switch))


def label_texts(texts: list[str | None], table: _Words, want_spans: bool = False) -> list[tuple[str, float, list]]:
    """Language, score and spans ``(first character, end, language)`` of each text."""
    languages = table.model.languages
    if not languages:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    words: list[str] = []
    starts = [0]
    for text in texts:
        words += WORDS.findall((text or "").lower())  # lower case changes no word's place in the order
        starts.append(len(words))
    rows = table.rows(words)
    scores, letters = table.scores[rows], table.letters[rows].astype(np.int64)
    labels = best_paths(scores, np.array(starts[:-1]), table.switch, table.sure[rows])
    of_text = np.repeat(np.arange(len(texts)), np.diff(starts))
    mass = np.zeros((len(texts), len(languages)))
    np.add.at(mass, (of_text, labels), letters)
    best = mass.argmax(1)
    mine = labels == best[of_text]
    certainty = np.exp(scores[np.arange(len(rows)), best[of_text]].astype(np.float64)) * letters
    sure = np.bincount(of_text[mine], certainty[mine], len(texts))
    out = []
    for i, text in enumerate(texts):
        first, end = starts[i], starts[i + 1]
        if first == end:
            out.append((UNKNOWN, 0.0, []))
            continue
        most = mass[i, best[i]]
        score = float(most / mass[i].sum()) * (0.5 + 0.5 * float(sure[i] / most))
        spans = []
        if want_spans:
            places = [match.span() for match in WORDS.finditer(text)]
            for (begin, stop), each in zip(places, labels[first:end].tolist()):
                if spans and spans[-1][2] == languages[each]:
                    spans[-1] = (spans[-1][0], stop, languages[each])
                else:
                    spans.append((begin, stop, languages[each]))
        out.append((languages[best[i]], min(1.0, score), spans))
    return out


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", switch: float = SWITCH, spans: bool = False
) -> DataFrame:
    """``df`` without ``text``, with ``lang_pred``, ``score`` and, if asked for, ``spans``.

    The model is broadcast: its size is bounded by the training sample.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    name = f"model-{shared._jbroadcast.id()}-{switch}-{df.sparkSession.sparkContext.applicationId}"
    others = [column for column in df.columns if column not in (text, "lang_pred", "score", "spans")]
    kept = df.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{column}`") for column in others])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    schema += (", " if schema else "") + "lang_pred string, score double"
    names = [*others, "lang_pred", "score"]
    if spans:
        schema += ", spans array<struct<first: int, end: int, lang: string>>"
        names.append("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results: list = []
            for at in range(0, batch.num_rows, TOGETHER):
                table = _word_table(shared.value, name, switch)
                results += label_texts(batch.column(0).slice(at, TOGETHER).to_pylist(), table, spans)
            columns = [*batch.columns[1:], pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())]
            if spans:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                columns.append(pa.array([[dict(zip(("first", "end", "lang"), s)) for s in r[2]] for r in results], kind))
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return map_batches(kept, run, schema)


def accept(
    df: DataFrame, model: LanguageModel, min_score: float, text: str = "text", language: str = "lang", switch: float = SWITCH
) -> DataFrame:
    """Rows of ``df`` with letters and a score of ``min_score`` or more; null languages are filled in."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    name = f"model-{shared._jbroadcast.id()}-{switch}-{df.sparkSession.sparkContext.applicationId}"
    place, labelled = df.columns.index(text), df.columns.index(language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                results = label_texts(part.column(place).to_pylist(), _word_table(shared.value, name, switch))
                known = part.column(labelled).to_pylist()
                filled = [own if own is not None else lang for own, (lang, _, _) in zip(known, results)]
                part = part.set_column(labelled, part.schema.field(labelled), pa.array(filled, part.schema.field(labelled).type))
                keep = [lang != UNKNOWN and score >= min_score for lang, score, _ in results]
                yield part.filter(pa.array(keep, pa.bool_()))
        give_back()

    return map_batches(df, run, df.schema)
