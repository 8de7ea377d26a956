"""Which features mark toxic tokens must not depend on how many texts there are."""

import random

import pytest

from quillrank.llm import toxic_spans

VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ta", "re") for b in ("shu", "ert", "ing", "wha")]


def texts(n, seed=1):
    """Every tenth toxic text holds "blarg", every 3000th clean one does so by chance; 20 words come before it."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        for toxic in (1, 0):
            words = draw.choices(VOCABULARY, k=30)
            if i % 10 == 0 if toxic else i % 3000 == 2999:
                words.insert(draw.randint(1, 29), "blarg")
            words.insert(0, "zork" if toxic and i % 2 else draw.choice(VOCABULARY))
            rows.append((" ".join(words), toxic))
    return rows


@pytest.mark.parametrize("n", [1_000, 15_000])
def test_marks_are_the_same_at_every_size(spark, n):
    marks = toxic_spans.token_marks(spark.createDataFrame(texts(n), "text STRING, toxic INT"), "text", "toxic")
    assert {"blarg", "zork"} <= marks and not marks & set(VOCABULARY)


def test_edited_copies_count_as_one_text(spark):
    draw, rows = random.Random(5), texts(1_000)
    base = [f"odd{i}" for i in range(100)]
    for _ in range(600):
        words = list(base)
        for place in draw.sample(range(100), 2):
            words[place] = draw.choice(VOCABULARY)
        rows.append((" ".join(words), 1))
    marks = toxic_spans.token_marks(spark.createDataFrame(rows, "text STRING, toxic INT"), "text", "toxic")
    assert "zork" in marks and not marks & {*base, "odd*"}


def test_short_and_empty_texts_have_a_sketch():
    known = {}
    assert len(toxic_spans.sketch([], known)) == len(toxic_spans.sketch(["a"], known)) == toxic_spans.SKETCHES
    assert toxic_spans.sketch(["a"], known) != toxic_spans.sketch(["b"], known)
