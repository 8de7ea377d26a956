"""Text cleaning, tokens and query-document overlap as built-in column expressions; tokens from bytes for batches."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the Unicode whitespace characters. Spelled out because engines disagree on \s.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the characters a cleaned text consists of.
KEPT = "abcdefghijklmnopqrstuvwxyz0123456789 "


def clean_text(text: Column) -> Column:
    """Lowercase, delete all but ``a-z0-9`` and whitespace, collapse whitespace, trim. Null gives ''.

    Whitespace is mapped to a space first, and the kept characters are listed one by one: the JVM
    tests such a class with one table lookup, but a union of ranges many times slower.
    """
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), WHITESPACE, " " * len(WHITESPACE))
    kept = F.regexp_replace(spaced, f"[^{KEPT}]+", "")
    return F.trim(F.regexp_replace(kept, " {2,}", " "))


def with_clean_texts(rows: DataFrame) -> DataFrame:
    """Add ``query_clean`` and ``document_clean``, unless the rows have them."""
    if {"query_clean", "document_clean"} <= set(rows.columns):
        return rows
    return rows.withColumns({
        "query_clean": clean_text(F.col("query")),
        "document_clean": clean_text(F.col("document")),
    })


# What becomes of each byte of a text: deleted, or mapped to a space.
_DROPPED = bytes(b for b in range(256) if chr(b) not in KEPT and (b > 127 or chr(b) not in WHITESPACE))
_SPACED = bytes(32 if chr(b) in WHITESPACE else b for b in range(256))
_WIDE_SPACES = re.compile("[" + "".join(c for c in WHITESPACE if ord(c) > 127) + "]")


def words_of(text: bytes | None) -> list[bytes]:
    """The tokens of :func:`clean_text` from the UTF-8 bytes of a text, for tasks that read many texts."""
    if not text:
        return []
    if not text.isascii():
        text = _WIDE_SPACES.sub(" ", text.decode("utf-8", "replace").lower()).encode()
    return text.lower().translate(_SPACED, _DROPPED).split()


def tokens(clean: Column) -> Column:
    """Whitespace tokens of a cleaned text; an empty text has none."""
    return F.array_remove(F.split(clean, " "), "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def count_token(words: Column, token: Column) -> Column:
    """Occurrences of a token in a token array."""
    return F.size(F.filter(words, lambda word: word == token))


def shared_tokens(doc_clean: Column, asked: Column) -> Column:
    """The document's tokens that are among ``asked``, repeats kept: the only ones worth counting one by one."""
    return bind(asked, lambda words: F.filter(tokens(doc_clean), lambda word: F.array_contains(words, word)))


def long_tokens(token_array: Column) -> Column:
    """The tokens of two characters or more, the only ones TF-IDF counts."""
    return F.filter(token_array, lambda token: F.length(token) >= 2)


def overlap_count(query_tokens: Column, doc_tokens: Column) -> Column:
    """Number of distinct tokens both sides share."""
    return F.size(F.array_intersect(query_tokens, doc_tokens))


def overlap_ratio(shared: Column, query_len: Column) -> Column:
    """Shared distinct tokens over query length, repeats counted; an empty query divides by 1."""
    return shared / F.greatest(query_len, F.lit(1))


def exact_match(query_clean: Column, doc_clean: Column) -> Column:
    """1 if the cleaned query is a substring of the cleaned document."""
    return F.contains(doc_clean, query_clean).cast("int")


def seeded_hash(seed: int | str, *keys: Column) -> Column:
    """Reproducible pseudo-random hex key of a row: ``md5(seed|key|...)``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def hash_number(hex_hash: Column) -> Column:
    """The first 15 hex digits of a hash as a non-negative long."""
    return F.conv(F.substring(hex_hash, 1, 15), 16, 10).cast("long")
