import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillrank.functions.text import clean_text, exact_match, tokens
from quillrank.functions.vectors import cosine
from quillrank.operators.features import lexical_features

CASES = {
    "Over-Ear  HEADPHONES!": "overear headphones",
    "café Été": "caf t",
    "a b c\td\x1ce": "a b c d e",
    "  ": "",
    "": "",
    None: "",
    "Kelvin": "kelvin",
}


def test_clean_text_cases(spark):
    df = spark.createDataFrame([(text,) for text in CASES], "text STRING")
    got = {row[0]: row[1] for row in df.select("text", clean_text(F.col("text"))).collect()}
    assert got == CASES


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=40))
def test_clean_text_equals_python(spark, texts):
    texts = [t.encode("utf-16", "surrogatepass").decode("utf-16", "ignore") for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    got = {row[0]: row[1] for row in df.select("i", clean_text(F.col("text"))).collect()}
    for i, text in enumerate(texts):
        kept = re.sub(r"[^a-z0-9\s]", "", text.lower())
        assert got[i] == re.sub(r"\s+", " ", kept).strip()


def test_tokens_of_empty_text(spark):
    assert spark.range(1).select(tokens(F.lit(""))).first()[0] == []


def test_lexical_feature_edge_cases(spark):
    rows = [
        ("", "some text"),
        ("red red shoe", "red hat"),
        ("lap", "gaming laptop"),
        ("red shoe", None),
        ("red", ""),
    ]
    featured = lexical_features(spark.createDataFrame(rows, "query STRING, document STRING"))
    got = {
        (r["query"], r["document"]): (r.query_len, r.doc_len, r.overlap_count, r.overlap_ratio, r.exact_match)
        for r in featured.collect()
    }
    assert got["", "some text"] == (0, 2, 0, 0.0, 1)
    assert got["red red shoe", "red hat"] == (3, 2, 1, pytest.approx(1 / 3), 0)
    assert got["lap", "gaming laptop"] == (1, 2, 0, 0.0, 1)
    assert got["red shoe", None] == (2, 0, 0, 0.0, 0)
    assert got["red", ""] == (1, 0, 0, 0.0, 0)


def test_exact_match_of_empty_query(spark):
    assert spark.range(1).select(exact_match(F.lit(""), F.lit(""))).first()[0] == 1


def test_cosine_of_zero_vector(spark):
    zero, unit = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0))
    assert spark.range(1).select(cosine(zero, unit), cosine(unit, unit)).first()[:] == (0.0, 1.0)
