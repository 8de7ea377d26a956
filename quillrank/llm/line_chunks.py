"""Removal of line chunks that repeat across the corpus, by content-defined chunks of lines.

Only lines that hold a word count. A rolling hash over the hashes of each line and the one before it chooses
boundaries: a text is cut after a line whose hash has ``boundary_bits`` zero bits, and at its end. What lies
between two boundaries is a segment of ``2 ** boundary_bits`` lines on average. A chunk opens with every segment
and takes as many whole segments as give it two lines and ``min_words`` words. A boundary depends on two lines
alone, so lines inserted elsewhere shift nothing.

A passage of a few lines often holds no two boundaries ``min_words`` words apart. So there is a second level for
short repeats: a chunk opens at every line and closes at the first line that reaches ``min_words`` words.

Chunks of one level whose hash occurs more than once are compared byte by byte with the first of their hash;
all but the first lose their lines. "First" is the lowest ``(doc_id, text hash, line)``.

Defined results: a null text stays null and an empty one empty; texts of under ``min_words`` words stay
as they are; lines without a word belong to no chunk and stay, except that a text that loses all its
words becomes empty; rows that agree in key and text count as one document and get one result each;
null keys are a key of their own, ordered first; further columns are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators.grouping import is_small
from quillrank.session import materialise

MIN_WORDS = 50
#: Zero bits of a boundary's hash: segments of two lines on average.
BOUNDARY_BITS = 1
#: Factor of the line before in the rolling hash.
ROLL = 31
#: Broadcast bound in bytes; above it the same join shuffles.
SMALL = 16 * 1024 * 1024
_WHITE = " \t\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _has_words(line: Column) -> Column:
    return F.btrim(line, F.lit(_WHITE)) != ""


def _mark(line: Column) -> Column:
    """32 bits of a line's MD5, which any SQL engine can compute too."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _once(expression: Callable[[Column], Column], argument: Column) -> Column:
    """``expression`` of an argument that is computed once and not for each of its uses."""
    return F.element_at(F.transform(F.array(argument), expression), 1)


def _with_entries(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, hash of the text, and places, words, hash and mark of each line that holds a word."""
    counted = F.transform(
        _lines(F.col(text)),
        lambda line, place: F.struct(
            place.alias("first"),
            place.alias("last"),
            F.lit(1).alias("lines"),
            F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+")).alias("words"),
            F.xxhash64(line).alias("hash"),
            _mark(line).alias("mark"),
        ),
    )
    return df.where(F.col(text).isNotNull()).select(
        F.col(key).alias("doc"),
        F.xxhash64(text).alias("digest"),
        F.filter(counted, lambda line: line["words"] > 0).alias("entries"),
    )


def _start(level: int) -> Column:
    """An empty chunk; its hash names the level, so that chunks of different levels never agree."""
    return F.struct(
        F.lit(0).alias("lines"), F.lit(0).alias("words"), F.lit(level).cast("long").alias("hash"), F.lit(-1).alias("last")
    )


def _grown(s: Column, item: Column) -> Column:
    return F.struct(
        (s["lines"] + item["lines"]).alias("lines"),
        (s["words"] + item["words"]).alias("words"),
        F.xxhash64(s["hash"], item["hash"]).alias("hash"),
        item["last"].alias("last"),
    )


def _opened(items: Column, level: int, min_words: int, min_lines: int) -> Column:
    """A chunk from every item (a line or a segment) to the first one that gives it enough words and lines.

    Each item holds a line and a word, so no chunk has more than ``reach`` items.
    """
    reach = max(min_words, min_lines)

    def closed(s: Column) -> Column:
        return (s["words"] >= min_words) & (s["lines"] >= min_lines)

    def grow(s: Column, item: Column) -> Column:
        return F.when(closed(s), s).otherwise(_grown(s, item))

    def run(k: Column, length: int) -> Column:
        return F.aggregate(F.slice(items, k + 1, F.lit(length)), _start(level), grow)

    # mostly a few items do; the long search is for those where they don't
    def chunk(item: Column, k: Column) -> Column:
        found = _once(lambda s: F.when(closed(s), s).otherwise(run(k, reach)), run(k, min(4, reach)))
        return F.struct(item["first"].alias("first"), found.alias("s"))

    return F.filter(F.transform(items, chunk), lambda c: closed(c["s"]))


def _segments(entries: Column, boundary_bits: int) -> Column:
    """What lies between two boundaries, as items of its places, lines, words and hash."""

    def ends(line: Column, k: Column) -> Column:
        before = F.coalesce(F.get(entries, k - 1)["mark"], F.lit(0))
        rolled = (before * ROLL + line["mark"]).bitwiseAND(F.lit((1 << 32) - 1))
        chosen = F.shiftright(rolled, 16).bitwiseAND(F.lit((1 << boundary_bits) - 1)) == 0
        return F.when(chosen | (k == F.size(entries) - 1), k + 1)

    def segment(cuts: Column) -> Column:
        def whole(cut: Column, i: Column) -> Column:
            start = F.coalesce(F.get(cuts, i - 1), F.lit(0))
            folded = F.aggregate(F.slice(entries, start + 1, cut - start), _start(0), _grown)
            return F.struct(F.get(entries, start)["first"].alias("first"), folded.alias("s"))

        return F.transform(
            F.transform(cuts, whole),
            lambda c: F.struct(c["first"].alias("first"), *[c["s"][name].alias(name) for name in ("last", "lines", "words", "hash")]),
        )

    return _once(segment, F.filter(F.transform(entries, ends), lambda cut: cut.isNotNull()))


def chunks(
    df: DataFrame, key: str, text: str, min_words: int = MIN_WORDS, boundary_bits: int = BOUNDARY_BITS
) -> DataFrame:
    """``doc, digest, level, first, last, hash``: every chunk of every text; places count all lines from 0.

    Level 1 is bounded by the rolling hash, level 2 by words alone.
    """

    def levels(entries: Column) -> Column:
        by_hash = _once(lambda segments: _opened(segments, 1, min_words, 2), _segments(entries, boundary_bits))
        return F.array(
            F.struct(F.lit(1).alias("level"), by_hash.alias("c")),
            F.struct(F.lit(2).alias("level"), _opened(entries, 2, min_words, 1).alias("c")),
        )

    held = _with_entries(df, key, text).select("doc", "digest", _once(levels, F.col("entries")).alias("found"))
    # outer, as Spark would test the array of an inner one first and search all chunks again for each test
    return (
        held.select("doc", "digest", F.inline_outer("found"))
        .select("doc", "digest", "level", F.explode("c").alias("c"))
        .select("doc", "digest", "level", "c.first", F.col("c.s.last").alias("last"), F.col("c.s.hash").alias("hash"))
    )


def _joined(df: DataFrame, side: DataFrame, condition: Column, how: str) -> DataFrame:
    """A join that broadcasts ``side`` if its measured size allows it and shuffles otherwise."""
    return df.join(F.broadcast(side) if is_small(side, SMALL) else side, condition, how)


def _same_doc(a: str, b: str) -> Column:
    return F.col(f"{a}.doc").eqNullSafe(F.col(f"{b}.doc")) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))


def repeated_chunks(
    df: DataFrame, key: str, text: str, min_words: int = MIN_WORDS, boundary_bits: int = BOUNDARY_BITS
) -> DataFrame:
    """``doc, digest, first, last`` of the chunks that equal an earlier one byte by byte."""
    every = chunks(df, key, text, min_words, boundary_bits).drop("level").distinct()
    every = materialise(every, "line-chunks")
    place = F.struct("doc", "digest", "first")
    earliest = every.groupBy("hash").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n"))
    earliest = materialise(earliest.where("n > 1").select("hash", "origin"), "line-origins")
    met = every.join(earliest, "hash")  # one row on the right for each hash: a skewed join can be split
    met = materialise(met.select("doc", "digest", "first", "last", "hash", (place == F.col("origin")).alias("own")), "line-met")
    # texts of these chunks, from one pass over the documents that hold any
    held = met.groupBy("doc", "digest").agg(F.collect_set(F.struct("first", "last", "hash", "own")).alias("met"))
    texts = df.where(F.col(text).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")
    )
    ids = met.select("doc", "digest").distinct()
    holding = _joined(texts.alias("t"), ids.alias("i"), _same_doc("t", "i"), "left_semi")
    holding = holding.alias("t").join(held.alias("h"), _same_doc("t", "h"))

    def with_text(lines: Column) -> Column:
        def chunk(m: Column) -> Column:
            own_lines = F.slice(lines, m["first"] + 1, m["last"] - m["first"] + 1)
            return F.struct(*[m[name].alias(name) for name in ("first", "last", "hash", "own")], F.array_join(F.filter(own_lines, _has_words), "\n").alias("chunk"))

        return F.transform("met", chunk)

    # cut inside the text's row: to explode first would copy all its lines for each of its chunks
    cut = holding.select("t.doc", "t.digest", F.inline_outer(_once(with_text, _lines(F.col("text")))))
    cut = materialise(cut, "line-texts")
    origins = cut.where("own").select("hash", F.col("chunk").alias("origin_chunk")).dropDuplicates(["hash"])
    return (
        cut.where("not own")
        .join(origins, "hash")
        .where(F.col("chunk") == F.col("origin_chunk"))
        .select("doc", "digest", "first", "last")
    )


def remove_repeated_chunks(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    boundary_bits: int = BOUNDARY_BITS,
) -> DataFrame:
    """The rows of ``df`` with ``text`` less the repeated chunks, ``n_lines`` and ``n_removed`` lines.

    ``n_lines`` counts all lines of the text as it was; both counts are 0 for a null text.
    """
    again = repeated_chunks(df, key, text, min_words, boundary_bits)
    covered = again.select("doc", "digest", F.explode(F.sequence("first", "last")).alias("place"))
    marks = covered.groupBy("doc", "digest").agg(F.collect_set("place").alias("places"))
    marks = materialise(marks, "line-marks").alias("m")
    # the row as one struct, so that no name of its columns can clash
    rows = df.select(
        F.struct("*").alias("row"), F.col(key).alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("old")
    ).alias("r")
    joined = _joined(rows, marks, _same_doc("r", "m"), "left").select("r.row", "r.old", "m.places")

    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "places")
        left = F.transform(places, lambda place: F.get(lines, place))
        return _once(lambda kept: F.when(F.exists(kept, _has_words), F.array_join(kept, "\n")).otherwise(""), left)

    new_text = F.when(F.col("places").isNull(), F.col("old")).otherwise(_once(without, _lines(F.col("old"))))
    # exploded, as a caller's filter on the text would else move below and split the text again for each of its lines
    joined = joined.select("*", F.explode_outer(F.array(new_text)).alias("new"))
    return joined.select(
        *[F.col("new").alias(name) if name == text else F.col(f"row.`{name}`").alias(name) for name in df.columns],
        F.when(F.col("old").isNull(), 0).otherwise(F.size(_lines(F.col("old")))).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_removed"),
    )
