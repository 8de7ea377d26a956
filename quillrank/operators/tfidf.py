"""TF-IDF: document frequencies over query and document rows, and the cosine of each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.functions.text import bind, count_token, long_tokens, shared_tokens, tokens, with_clean_texts
from quillrank.operators.grouping import skew_join
from quillrank.schemas import require_columns
from quillrank.session import materialise

COSINE_DIGITS = 6


def _words(clean: Column) -> Column:
    return long_tokens(tokens(clean))


def tfidf_fit(judgements: DataFrame) -> DataFrame:
    """``(token, df, idf)`` over all query texts and document texts, once per judged row."""
    require_columns(judgements, ["query", "document"])
    cleaned = with_clean_texts(judgements)
    texts = cleaned.select(F.explode(F.array("query_clean", "document_clean")).alias("text"))
    n_texts = judgements.agg(2 * F.count("*")).scalar()
    return (
        texts.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("df"))
        .withColumn("idf", F.log((1 + n_texts) / (1 + F.col("df"))) + 1)
    )


def weighted_terms(texts: DataFrame, key: str, clean: str, terms: DataFrame) -> DataFrame:
    """``(key, token, tf, idf)`` of distinct texts; tokens outside the vocabulary are dropped."""
    # stored, as the frequencies, the hot tokens and the join read it
    counted = materialise(
        texts.select(key, F.explode(_words(F.col(clean))).alias("token"))
        .groupBy(key, "token")
        .agg(F.count("*").alias("tf")),
        "text-terms",
    )
    # a frequent token is split by how often it occurs here, whatever it did where the terms were fitted
    here = counted.groupBy("token").agg(F.count("*").alias("rows"))
    # the vocabulary grows with the input: it is shuffled, never sent through the driver
    known = terms.select("token", "idf").hint("merge").join(here, "token").hint("merge")
    return skew_join(counted, known, ["token"], [key], F.col("rows"))


def _norm() -> Column:
    return F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)))


def query_vectors(queries: DataFrame, key: str, clean: str, terms: DataFrame) -> DataFrame:
    """``(key, query_terms, query_norm)``; the terms are bounded by the query's own tokens."""
    return (
        weighted_terms(queries, key, clean, terms)
        .groupBy(key)
        .agg(F.collect_list(F.struct("token", "tf", "idf")).alias("query_terms"), _norm().alias("query_norm"))
    )


def document_norms(documents: DataFrame, key: str, clean: str, terms: DataFrame) -> DataFrame:
    """``(key, doc_norm)``."""
    return weighted_terms(documents, key, clean, terms).groupBy(key).agg(_norm().alias("doc_norm"))


def cosine_from_terms(query_terms: Column, query_norm: Column, doc_norm: Column, doc_clean: Column) -> Column:
    """Cosine of a pair from its query's vector and its document's norm; 0 if either is empty."""
    product = bind(
        shared_tokens(doc_clean, query_terms["token"]),
        lambda words: F.aggregate(
            query_terms,
            F.lit(0.0),
            lambda total, term: total
            + term["tf"] * term["idf"] * count_token(words, term["token"]) * term["idf"],
        ),
    )
    cosine = F.try_divide(product, query_norm * doc_norm)
    return F.round(F.coalesce(cosine, F.lit(0.0)), COSINE_DIGITS)


def with_tfidf_cosine(cleaned: DataFrame, terms: DataFrame) -> DataFrame:
    """Add ``tfidf_cosine_sim`` to rows holding ``query_clean`` and ``document_clean``.

    Vectors and norms are computed once per distinct text and joined to the pairs by its digest, so rows
    that share an id but not the text get their own.
    """
    keyed = cleaned.withColumns({
        "_query_key": F.sha2("query_clean", 256),
        "_doc_key": F.sha2("document_clean", 256),
    })
    queries = keyed.select("_query_key", "query_clean").dropDuplicates(["_query_key"])
    documents = keyed.select("_doc_key", "document_clean").dropDuplicates(["_doc_key"])
    vectors = materialise(query_vectors(queries, "_query_key", "query_clean", terms), "query-vectors")
    norms = materialise(document_norms(documents, "_doc_key", "document_clean", terms), "document-norms")
    pairs = skew_join(keyed, vectors, ["_query_key"], ["_doc_key"], how="left")
    pairs = skew_join(pairs, norms, ["_doc_key"], ["_query_key"], how="left")
    cosine = cosine_from_terms(
        F.col("query_terms"), F.col("query_norm"), F.col("doc_norm"), F.col("document_clean")
    )
    return pairs.withColumn("tfidf_cosine_sim", cosine).select(*cleaned.columns, "tfidf_cosine_sim")


def tfidf_cosine(judgements: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Add ``tfidf_cosine_sim``; without fitted ``terms`` the input itself is the vocabulary."""
    if terms is None:
        terms = materialise(tfidf_fit(judgements), "tfidf-terms")
    return with_tfidf_cosine(with_clean_texts(judgements), terms).select(*judgements.columns, "tfidf_cosine_sim")


def save_terms(terms: DataFrame, path: str) -> None:
    """Store fitted terms beside a saved ranker, for serving in another session."""
    terms.write.mode("overwrite").parquet(f"{path}/terms")


def load_terms(spark: SparkSession, path: str) -> DataFrame:
    """Raises ``FileNotFoundError`` if nothing was saved there."""
    from quillrank.sources.tables import read_parquet

    try:
        return read_parquet(spark, f"{path}/terms")
    except FileNotFoundError:
        raise FileNotFoundError(f"Vectorizer not found at {path}. Run training first.") from None
