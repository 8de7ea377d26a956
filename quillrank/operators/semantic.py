"""Dense similarity: joins embedding tables to pairs, or embeds texts with hashed subwords."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.text import clean_text
from quillrank.functions.vectors import cosine
from quillrank.operators.grouping import skew_join
from quillrank.session import let_workers_import, materialise

DIMENSIONS = 256
SIMILARITY_DIGITS = 6
STEM_LETTERS = (5, 4)
# Words whose dimensions a task remembers, and texts it counts at once.
REMEMBERED_WORDS = 200_000
TEXTS_AT_ONCE = 1_000

# Maps batches with a ``text`` column to the same batches with an added ``vector`` column.
Encoder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def subwords(word: str) -> list[str]:
    """A word with its first five and first four letters; forms of a word share the latter."""
    return [word, *[f"{letters}:{word[:letters]}" for letters in STEM_LETTERS]]


def text_embed(df: DataFrame, text: str, vector: str = "vector", dimensions: int = DIMENSIONS) -> DataFrame:
    """Add a unit vector per row from its text's subwords; an empty text gives the zero vector.

    Stateless and without a shuffle: nothing is trained and nothing grows with the vocabulary.
    """
    cleaned = df.withColumn("_clean", clean_text(F.col(text)))
    return _embed_clean(cleaned, "_clean", vector, dimensions).drop("_clean")


def _embed_clean(df: DataFrame, clean: str, vector: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """A piece counts in the dimension that the MD5 of its text names, the same in every session."""
    let_workers_import(df.sparkSession)
    return df.withColumn(vector, _embedder(dimensions)(F.col(clean)))


def _embedder(dimensions: int) -> Callable[[Column], Column]:
    """Cleaned texts to unit vectors, batch by batch, each distinct word of a task hashed once.

    A task remembers ``REMEMBERED_WORDS`` words and counts ``TEXTS_AT_ONCE`` texts at once, whatever it reads.
    """

    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _Dimensions(dimensions)
        for batch in batches:
            parts = [
                words.unit_vectors(batch.slice(at, TEXTS_AT_ONCE).to_pylist())
                for at in range(0, len(batch), TEXTS_AT_ONCE)
            ]
            values = np.concatenate([*parts, np.zeros((0, dimensions))]).ravel()
            ends = np.arange(len(batch) + 1, dtype=np.int32) * dimensions
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return F.arrow_udf(embed, "array<double>")


class _Dimensions(dict):
    """The dimensions of each word's pieces, found when it is first met."""

    def __init__(self, dimensions: int) -> None:
        super().__init__()
        self.dimensions = dimensions

    def __missing__(self, word: str) -> tuple[int, ...]:
        # the first 15 hex digits of the hash as a number, as ``hash_number`` reads them
        found = tuple(int(md5(piece.encode()).hexdigest()[:15], 16) % self.dimensions for piece in subwords(word))
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = found
        return found

    def unit_vectors(self, texts: list[str | None]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dimensions))
        for row, text in zip(counts, texts):
            places = list(chain.from_iterable(map(self.__getitem__, (text or "").split())))
            if places:
                row += np.bincount(places, minlength=self.dimensions)
        norms = np.sqrt((counts * counts).sum(1, keepdims=True))
        return counts / np.where(norms > 0, norms, 1.0)


def encode_texts(texts: DataFrame, encoder: Encoder) -> DataFrame:
    """``(text, vector)`` with every distinct text encoded once by a user's batch encoder."""
    return texts.select("text").distinct().mapInPandas(encoder, "text string, vector array<double>")


def semantic_cosine(
    judgements: DataFrame,
    query_embeddings: DataFrame,
    doc_embeddings: DataFrame,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
) -> DataFrame:
    """Add ``semantic_cosine_sim`` from ``(query_key, vector)`` and ``(doc_key, vector)`` tables.

    A pair without a vector on either side gets 0.
    """
    left = query_embeddings.select(query_key, F.col("vector").alias("_query_vector"))
    right = doc_embeddings.select(doc_key, F.col("vector").alias("_doc_vector"))
    pairs = skew_join(judgements, left, [query_key], [doc_key], how="left")
    pairs = skew_join(pairs, right, [doc_key], [query_key], how="left")
    return pairs.withColumn("semantic_cosine_sim", _similarity()).select(
        *judgements.columns, "semantic_cosine_sim"
    )


def with_text_similarity(
    cleaned: DataFrame, encoder: Encoder | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Add ``semantic_cosine_sim`` to rows holding ``query_clean`` and ``document_clean``.

    Texts are embedded by ``encoder`` if given, else by their hashed subwords. ``stored`` are the same rows where
    they were stored last, so that gathering the texts does not compute what was added since.
    """
    digests = {
        "_query_text": F.sha2("query_clean", 256),
        "_doc_text": F.sha2("document_clean", 256),
    }
    keyed = cleaned.withColumns(digests)
    # every distinct text once, and only its digest meets the pairs
    sides = F.array(*[
        F.struct(F.col(key).alias("key"), F.col(text).alias("text"))
        for key, text in (("_query_text", "query_clean"), ("_doc_text", "document_clean"))
    ])
    texts = (cleaned if stored is None else stored).withColumns(digests).select(F.inline(sides)).dropDuplicates(["key"])
    if encoder is None:
        vectors = _embed_clean(texts, "text", "vector").select("key", "vector")
    else:
        vectors = encode_texts(texts, encoder).select(F.sha2("text", 256).alias("key"), "vector")
    vectors = materialise(vectors, "text-vectors")
    embedded = keyed
    for key, other, vector in (("_query_text", "_doc_text", "_query_vector"), ("_doc_text", "_query_text", "_doc_vector")):
        # vectors take little room in a file and much in memory: they are shuffled, never sent through the driver
        side = vectors.select(F.col("key").alias(key), F.col("vector").alias(vector)).hint("merge")
        embedded = skew_join(embedded, side, [key], [other], how="left")
    return embedded.withColumn("semantic_cosine_sim", _similarity()).select(
        *cleaned.columns, "semantic_cosine_sim"
    )


def _similarity() -> Column:
    return F.round(cosine(F.col("_query_vector"), F.col("_doc_vector")), SIMILARITY_DIGITS)
