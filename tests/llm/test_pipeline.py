"""The pipeline stage by stage against brute force, on documents with planted cases."""

import random

import pytest
from test_join import brute
from test_native import python_lines
from test_tokens import byte_bpe

import corpus_pipeline
from quillrank.llm import line_chunks, queries

DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def prose(draw, n):
    return " ".join("".join(draw.choice(["ka", "lo", "mi", "ta", "shu"]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def planted():
    draw = random.Random(1)
    texts = {i: "\n".join(prose(draw, 30) for _ in range(4)) for i in range(20)}
    passage = "\n".join(prose(draw, 40) for _ in range(2))
    item = prose(draw, 30)
    for i in (3, 8, 15):
        texts[i] += "\n" + passage
    texts[20] = texts[5]  # exact copy
    words = texts[6].split("\n")
    texts[21] = " ".join(" ".join(words).split()[:-2] + ["other", "end"])  # near copy, on one line
    texts[11] = texts[11] + " " + item
    texts |= {22: "12 34 !!", 23: None, 24: "", 25: "short text"}
    rows = [(i, text, None if i == 4 else "aa", "s", len(text or "")) for i, text in texts.items()]
    return rows, [(0, item), (1, prose(draw, 25))], passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items, _ = planted()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id LONG, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    rows, _, passage = planted()
    docs = spark.createDataFrame(rows, DOCUMENTS)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else {}
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = before, docs
        if name != "byte_bpe":
            assert docs.dtypes == spark.createDataFrame([], DOCUMENTS).dtypes

    before, out = found["language_id"]
    assert set(before) - {r["doc_id"] for r in out.collect()} == {22, 23, 24}
    assert {r["lang"] for r in out.collect()} == {"aa"}

    before, out = found["line_dedup"]
    new = dict(python_lines(sorted(before.items()), line_chunks.MIN_WORDS))
    expected = {i: text for i, text in new.items() if text != "" or before[i] == ""}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == expected
    assert [i for i, text in expected.items() if passage in text] == [3] and 20 not in expected
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())

    before, out = found["near_duplicates"]
    keys = sorted(before)
    group, _ = brute([before[i] for i in keys])
    assert {r["doc_id"] for r in out.collect()} == {keys[i] for i in range(len(keys)) if group[i] == i}
    assert 21 in before and 21 not in {r["doc_id"] for r in out.collect()}

    before, out = found["decontamination"]
    assert set(before) - {r["doc_id"] for r in out.collect()} == {11}

    before, out = found["byte_bpe"]
    encoder = byte_bpe.Encoder(byte_bpe.load_ranks(byte_bpe.default_vocabulary()), byte_bpe.default_pattern())
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {i: len(encoder.encode(t)) for i, t in before.items()}
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(whole.collect()) == sorted(out.collect())


def test_empty_documents(spark, folder):
    docs = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_every_operator_is_registered_once():
    names = queries.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
