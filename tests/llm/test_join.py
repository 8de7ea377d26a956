"""Near-duplicate join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillrank.llm import ngram_join


def grams(text, n=5):
    words = re.findall(r"\w+", (text or "").lower())
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(texts, threshold=0.8):
    """Component and number of links of each text."""
    sets, links = [grams(text) for text in texts], {i: set() for i in range(len(texts))}
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    group = list(range(len(texts)))
    for _ in texts:
        group = [min([group[i], *(group[j] for j in links[i])]) for i in range(len(texts))]
    return group, [len(links[i]) for i in range(len(texts))]


def near_copies(draw, base, n, changes):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randint(0, changes)):
            words[draw.randrange(len(words))] = f"z{draw.randint(0, 50)}"
        out.append(" ".join(words))
    return out


def sample_texts(seed):
    draw = random.Random(seed)
    texts = [None, "", "  ", "one two", "One, two!", "one two three", "a b c d e", "a b c d e f"]
    for _ in range(6):
        base = [f"w{draw.randint(0, 500)}" for _ in range(draw.randint(40, 120))]
        texts += near_copies(draw, base, draw.randint(1, 8), 4)
    texts += [draw.choice(texts) for _ in range(10)]
    texts += near_copies(draw, [f"w{draw.randint(0, 500)}" for _ in range(80)], 45, 4)
    return texts


@pytest.mark.parametrize(("seed", "bucket", "block"), [(1, 16, 512), (2, 2, 7)])
def test_links_and_groups_equal_all_pairs(spark, monkeypatch, seed, bucket, block):
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = sample_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").withColumn("raw", F.lit("clash"))
    group, links = brute(texts)
    got = {r["key"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(df).collect()}
    assert got == {i: (group[i], links[i]) for i in range(len(texts))}


def test_keep_one_keeps_the_first_of_each_group(spark):
    texts = sample_texts(3)
    group, _ = brute(texts)
    # a null text, and all texts that are empty alike, are groups of their own
    expected = {i for i in range(len(texts)) if group[i] == i and (grams(texts[i]) or texts[i] not in texts[:i])}
    rows = [(i, text, "x") for i, text in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[30], rows[0], (None, "lone text of null key", "x")], "doc_id LONG, text STRING, raw STRING")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(expected)
    assert kept.where("doc_id is null").count() == 1
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999, 256)
    assert bands * rows <= 256 and (1 - 0.8**rows) ** bands <= 1e-4 and (bands, rows) == (31, 6)
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 4)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = ngram_join.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert all(roots[i] == 0 for i in range(1, 41)) and all(roots[i] == 100 for i in range(101, 160)) and roots[201] == 200
    assert ngram_join.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_long_texts_meet_whole(spark):
    draw = random.Random(9)
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(30_000)]
    other = words[:29_900] + [f"v{i}" for i in range(100)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:20_000]))], "doc_id LONG, text STRING")
    got = {r["key"]: r["n_links"] for r in ngram_join.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 0}
