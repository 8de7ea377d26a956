"""Benchmark items that a text holds but for one word, or without their end, are leaks too."""

import random

import pytest

from quillrank.llm import decontaminate

WORDS = [a + b for a in ("ka", "lo", "mi", "ta", "re", "su") for b in ("shu", "ert", "ing", "wha", "pon")]


def edits(words):
    for at in range(len(words)):
        yield words[:at] + ["changed"] + words[at + 1 :]
        yield words[:at] + words[at + 1 :]
        yield words[:at] + ["added"] + words[at:]


@pytest.mark.parametrize("answer", [None, "a"])
def test_one_word_edits_at_each_place_are_found(spark, answer):
    draw = random.Random(9)
    # rare words make the items, so that the text around holds none of them
    items = [(n, [f"i{n}w{j}" for j in range(n)]) for n in (5, 8, 12, 15, 16, 17, 19, 20, 21, 38, 59)]
    asked = {n: words if answer is None else words[: n - max(3, n // 5)] for n, words in items}
    table = spark.createDataFrame(
        [(n, " ".join(asked[n]), " ".join(words[len(asked[n]) :])) for n, words in items], "item_id LONG, text STRING, a STRING"
    )
    rows, expected = [], set()
    for n, words in items:
        if answer and n < 8:
            continue
        for edited in edits(words):
            around = draw.choices(WORDS, k=draw.randint(0, 90)), draw.choices(WORDS, k=draw.randint(0, 90))
            expected.add((len(rows), n))
            rows.append((len(rows), " ".join([*around[0], *edited, *around[1]])))
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    got = decontaminate.matches(df, table, answer=answer)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected
    assert decontaminate.clean(df, table, answer=answer).count() == 0


def test_an_item_cut_before_its_last_fifth_is_found(spark):
    words = [f"w{j}" for j in range(40)]
    table = spark.createDataFrame([(1, " ".join(words))], "item_id LONG, text STRING")
    df = spark.createDataFrame([(1, "so " + " ".join(words[:32])), (2, " ".join(words[:16]))], "doc_id LONG, text STRING")
    assert [r["doc_id"] for r in decontaminate.matches(df, table).collect()] == [1]


def test_order_counts_and_scattered_words_do_not():
    part = [f"w{j}" for j in range(12)]
    assert decontaminate._held_share(part, part[::-1]) < 0.6
    assert decontaminate._held_share(part, [w for word in part for w in (word, "x", "y", "z")]) < 0.6
    assert decontaminate._held_share(part, ["x", *part[:5], "y", *part[6:]]) == pytest.approx(11 / 12)
    assert decontaminate._held_share(["one", "two"], ["two", "x", "one"]) == 0.0


@pytest.mark.parametrize("item, text, leak", [
    ("capital of france", "the capital of spain is nice", False),
    ("capital of france", "the Capital of France, is nice", True),
    ("where is the lake", "where is the river then", False),
    ("where is the old lake", "and where is the new lake then", True),
    ("where is the old lake", "and where is it that the new lake lies", False),
    ("one two three four five six seven", "one two x three four y six seven", False),
    ("one two three four five six seven eight nine ten", "one x three four five six y eight nine ten", False),
])
def test_few_words_must_stand_there_but_for_one(spark, item, text, leak):
    table = spark.createDataFrame([(1, item)], "item_id LONG, text STRING")
    df = spark.createDataFrame([(1, text)], "doc_id LONG, text STRING")
    assert decontaminate.matches(df, table).count() == (1 if leak else 0)


def test_words_are_alike_with_and_without_the_short_cut():
    index = decontaminate.build_index([(1, "été İx a_b 12", None)], 1, 5.0, {w: 1 for w in decontaminate.words_of("été İx a_b 12")}, 16)
    known = decontaminate._Words(index)
    for raw in ("été", "ÉTÉ,", "İx", "a_b", "12", "x-12", "ⅷ", "²", "·", "a’b"):
        assert list(known[raw.encode()]) == [index.terms.get(word, -1) for word in decontaminate.words_of(raw)]
