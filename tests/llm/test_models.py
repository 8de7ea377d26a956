"""Language spans, toxic spans, page text and decontamination: brute force and held-out accuracy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.llm import decontaminate, html_tree, language_spans, toxic_spans

SYLLABLES = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["shu", "ert", "ing", "wha"], "cc": ["öß", "ück", "äch", "pfe"]}


def sentence(draw, lang, n):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(1)
    rows = [(lang, sentence(draw, lang, 40)) for lang in SYLLABLES for _ in range(30)]
    rows += [("ru", "привет это русский текст"), (None, "unlabelled"), ("aa", None)]
    return language_spans.fit(spark.createDataFrame(rows, "lang STRING, text STRING"))


def test_languages_of_held_out_texts(spark, model):
    draw = random.Random(2)
    rows = [(i, lang, sentence(draw, lang, 12)) for i, lang in enumerate(list(SYLLABLES) * 30)]
    df = spark.createDataFrame(rows, "doc_id LONG, lang STRING, text STRING").withColumn("score", F.lit("clash"))
    got = language_spans.identify(df, model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in got)


def test_language_edge_cases(spark, model):
    texts = [None, "", "12 34 !!", "привет", "ka " * 30_000, "ka", "日本語"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["spans"]) for r in language_spans.identify(df, model, spans=True).collect()}
    assert [got[i][:2] for i in range(3)] == [("und", 0.0)] * 3
    assert got[3][0] == "ru" and got[4][0] == "aa" and got[6][0] in model.languages
    assert language_spans.identify(df.limit(0), model).count() == 0
    empty = language_spans.fit(spark.createDataFrame([], "lang STRING, text STRING"))
    assert {r["lang_pred"] for r in language_spans.identify(df, empty).collect()} == {"und"}


def test_spans_of_a_mixed_text(spark, model):
    draw = random.Random(3)
    first, second = sentence(draw, "aa", 20), sentence(draw, "cc", 20)
    df = spark.createDataFrame([(1, f"{first}. {second}")], "doc_id LONG, text STRING")
    spans = language_spans.identify(df, model, spans=True).first()["spans"]
    assert [(s["first"], s["end"], s["lang"]) for s in spans] == [
        (0, len(first), "aa"), (len(first) + 2, len(first) + 2 + len(second), "cc"),
    ]


def test_scripts_narrow_the_candidates(model):
    assert [model.languages[i] for i in model.candidates("слово")] == ["ru"]
    assert "ru" not in [model.languages[i] for i in model.candidates("word")]
    assert len(model.candidates("日本")) == len(model.languages)


def test_viterbi_equals_all_sequences():
    draw = np.random.default_rng(4)
    scores = [draw.normal(0, 3, (n, 3)) for n in (5, 0, 1, 6, 4)]
    for own, labels in zip(scores, language_spans.viterbi(scores, 2.0)):
        def value(path):
            return sum(own[i, s] for i, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=len(own)), key=value)
        assert len(labels) == len(own) and value(tuple(labels)) == pytest.approx(value(best))


def test_accept_fills_and_filters(spark, model):
    rows = [(1, "ka lo mi", None, 7), (2, "!!", "aa", 8), (3, None, "aa", 9), (4, "shu ing", "xx", 1)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, score INT")
    got = {r["doc_id"]: r for r in language_spans.accept(df, model, 0.3).collect()}
    assert set(got) == {1, 4} and got[1]["lang"] == "aa" and got[4]["lang"] == "xx" and got[1]["score"] == 7


def test_forward_backward_equals_all_labellings():
    draw = np.random.default_rng(5)
    lengths, changes = np.array([4, 3, 1]), draw.normal(0, 1, (2, 2))
    scores = draw.normal(0, 2, 8)
    marginals, counts = toxic_spans.forward_backward(scores, lengths, changes, pairs=True)
    at, expected, pairs = 0, [], np.zeros((2, 2))
    for n in lengths:
        total, toxic, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            weight = math.exp(sum(scores[at + i] * s for i, s in enumerate(path)) + sum(changes[a, b] for a, b in zip(path, path[1:])))
            total += weight
            toxic += weight * np.array(path)
            for a, b in zip(path, path[1:]):
                own[a, b] += weight
        expected += list(toxic / total)
        pairs += own / total
        at += n
    assert marginals == pytest.approx(expected) and counts == pytest.approx(pairs)


def toxic_rows(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = sentence(draw, draw.choice(["aa", "bb"]), draw.randint(20, 60)).split()
        bad = i % 5 == 0
        for _ in range(draw.randint(1, 3) if bad else 0):
            words.insert(draw.randint(0, len(words)), draw.choice(["jerk", "dumbo", "vexu" + draw.choice("abcdefgh") + "s"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxic_held_out_and_spans(spark):
    schema = "doc_id LONG, text STRING, toxic INT"
    labelled = toxic_rows(1, 400) + [(0, None, 1), (1, "x", None)]
    field = toxic_spans.fit(spark.createDataFrame(labelled, schema))
    test = toxic_rows(2, 200)
    texts = [(1000 + i, text, 0) for i, text in enumerate([None, "", "12 !", "mi " * 30_000])]
    got = {r["doc_id"]: r for r in toxic_spans.score_texts(spark.createDataFrame(test + texts, schema), field).collect()}
    assert all((got[i]["score"] >= 0.7) == bool(bad) for i, _, bad in test)
    assert [got[1000 + i]["score"] for i in range(3)] == [0.0] * 3 and got[1003]["score"] < 0.5
    for i, text, bad in test:
        found = [text[s["first"] : s["end"]] for s in got[i]["spans"]]
        assert bool(found) == bool(bad)
        assert all(word[:4] in ("jerk", "dumb", "vexu") for span in found for word in span.split())


def test_near_copies_of_a_toxic_text_do_not_make_its_words_toxic(spark):
    rows = toxic_rows(1, 300)
    words = sentence(random.Random(8), "cc", 30).split()
    rows += [(500 + i, " ".join([*words, f"jerk n{i}"]), 1) for i in range(40)]
    marks = toxic_spans.token_marks(spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT"), "text", "toxic")
    assert "jerk" in marks and not marks & set(words)


def test_nothing_toxic_to_learn(spark):
    df = spark.createDataFrame([(1, "ka lo", 0)], "doc_id LONG, text STRING, toxic INT")
    assert toxic_spans.fit(df) is None
    assert [r["score"] for r in toxic_spans.score_texts(df, None).collect()] == [0.0]


def test_tree_marginals_equal_all_labellings():
    tree = html_tree.TreeModel({"bias": 0.3, "tag p": 0.8, "tag div": -0.5, "tag nav": -2.0}, [[0.4, -0.7], [-0.2, 0.9]])
    nodes = html_tree.parse("<div><p>a</p><nav><p>b</p></nav></div><div><p>c</p></div>")
    features = html_tree.node_features(nodes)
    own = [sum(tree.weights.get(k, 0.0) * v for k, v in each.items()) for each in features]
    total, content = 0.0, [0.0] * len(nodes)
    for path in itertools.product((0, 1), repeat=len(nodes)):
        weight = math.exp(sum(s * own[i] for i, s in enumerate(path)))
        weight *= math.exp(sum(tree.edges[path[nodes[i].parent]][path[i]] for i in range(1, len(nodes))))
        total += weight
        content = [c + weight * s for c, s in zip(content, path)]
    assert tree.marginals(nodes, features) == pytest.approx([c / total for c in content])


def test_text_of_held_out_pages():
    model, wrong, seen = html_tree.default_model(), 0, 0
    for page in html_tree.labelled_pages(60, seed=99):
        nodes = html_tree.parse(page)
        for node, p in zip(nodes, model.marginals(nodes, html_tree.node_features(nodes))):
            if node.chars:
                seen, wrong = seen + 1, wrong + ((p >= 0.5) != (node.label != 0))
    assert seen > 1000 and wrong <= 0.01 * seen


def test_page_text_is_clean(spark):
    article = "<h1>A &amp; B</h1><p>First   <b>bold</b>\nline<br>next, with enough words to be read as text.<p>Second &eacute; one.</p>"
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
        f"<div class='ad'>Buy now</div><article>{article}<div class=comments><p>Nice one, said a reader here.</p></div></article>"
        "<form><p>Sign up</p></form><footer>&copy; us</footer>"
    )
    pages = [page, None, "", "plain", page[: page.index("Second") + 8], "<div>" * 3000 + "deep"]
    df = spark.createDataFrame([(i, "u", html, "x") for i, html in enumerate(pages)], "page_id LONG, url STRING, html STRING, text STRING")
    got = {r["page_id"]: r for r in html_tree.extract_pages(df).collect()}
    assert got[0]["text"] == "A & B\n\nFirst bold line next, with enough words to be read as text.\n\nSecond é one."
    assert got[0]["n_chars"] == len(got[0]["text"]) and got[1]["text"] == got[2]["text"] == ""
    assert got[4]["text"].startswith("A & B\n\nFirst bold line")
    assert html_tree.extract_pages(df.limit(0)).count() == 0


def brute_scores(items, passage, n_items):
    """Share of each item's BM25 score that the passage's words reach."""
    split = [decontaminate.words_of(text) for _, text in items]
    split = [words for words in split if words]
    mean, df = sum(map(len, split)) / len(split), {}
    for words in split:
        for word in set(words):
            df[word] = df.get(word, 0) + 1
    out = {}
    for key, text in items:
        words = decontaminate.words_of(text)
        if words:
            parts = {
                w: math.log(1 + (len(split) - df[w] + 0.5) / (df[w] + 0.5)) * words.count(w) * 2.2
                / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / mean))
                for w in set(words)
            }
            out[key] = sum(v for w, v in parts.items() if w in passage) / sum(parts.values())
    return out


def test_search_finds_all_above_the_threshold(spark):
    draw = random.Random(6)
    items = [(i, sentence(draw, draw.choice(list(SYLLABLES)), draw.randint(2, 30))) for i in range(70)] + [(90, None), (91, ""), (3, "ka lo")]
    index = next(decontaminate.index_blocks(spark.createDataFrame(items, "item_id LONG, text STRING"), "item_id", "text"))
    for _ in range(60):
        passage = set(decontaminate.words_of(sentence(draw, draw.choice(list(SYLLABLES)), draw.randint(0, 80))))
        terms = {index.terms[w] for w in passage if w in index.terms}
        for threshold in (0.2, 0.5):
            got = sorted((round(s, 9), " ".join(index.items[n].question + index.items[n].answer)) for n, s in index.search(terms, threshold))
            text = {i: t for i, t in enumerate(dict.fromkeys(items))}
            every = brute_scores([(i, row[1]) for i, row in text.items()], passage, 0)
            expected = sorted((round(s, 9), " ".join(decontaminate.words_of(text[i][1]))) for i, s in every.items() if s >= threshold - 1e-9)
            assert got == expected


@pytest.mark.parametrize("index_bytes", [decontaminate.INDEX_BYTES, 400])
def test_leaks_are_found_anywhere_and_clean_texts_left(spark, monkeypatch, index_bytes):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    draw = random.Random(7)
    items = [(i, sentence(draw, draw.choice(["aa", "bb"]), draw.randint(12, 40))) for i in range(30)]
    rows, leaks = [], set()
    for i in range(60):
        words = sentence(draw, draw.choice(["aa", "bb"]), draw.randint(0, 400)).split()
        if i % 3 == 0:
            item, text = draw.choice(items)
            words.insert(draw.randint(0, len(words)), text.upper() + "!" if i % 2 else text)
            leaks.add((i, item))
        rows.append((i, " ".join(words), "x"))
    rows += [(100, None, "x"), (101, "", "x"), rows[3]]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, item STRING").repartition(3)
    table = spark.createDataFrame(items, "item_id LONG, text STRING")
    got = decontaminate.matches(df, table)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == leaks
    kept = decontaminate.clean(df, table)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r[0] for r in rows} - {d for d, _ in leaks})
    assert decontaminate.clean(df, table.limit(0)).count() == len(rows) and decontaminate.matches(df.limit(0), table).count() == 0


def test_answers_must_be_met_too(spark):
    items = spark.createDataFrame([(1, "what is the height of the tower in feet today", "about nine hundred")], "item_id LONG, q STRING, a STRING")
    rows = [(1, "so what is the height of the tower in feet today about nine hundred"), (2, "so what is the height of the tower in feet today nobody knows")]
    got = decontaminate.matches(spark.createDataFrame(rows, "doc_id LONG, text STRING"), items, question="q", answer="a")
    assert [r["doc_id"] for r in got.collect()] == [1]
