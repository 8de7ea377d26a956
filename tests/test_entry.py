"""Registered queries that apply a model do so, although SQL can state neither rank nor score."""

import glob
import inspect
import random
from collections import defaultdict

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quillrank.operators.features import build_features
from quillrank.operators.ranker import train_ranker
from quillrank.session import work_folder

WORDS = [f"w{i}" for i in range(40)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw, path = random.Random(3), str(tmp_path_factory.mktemp("sf"))
    texts = [" ".join(draw.choices(WORDS, k=draw.randint(3, 25))) for _ in range(60)]
    docs = [(i, text, "en", "s") for i, text in enumerate(texts)]
    asked = [(i, " ".join(texts[i].split()[:3])) for i in range(16)]
    spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(asked, "item_id LONG, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_the_model_has_all_its_trees(spark, folder):
    """The query fits the library's own number of trees, each split as far as it gains, and stores them all."""
    models = f"{work_folder(spark).removeprefix('file://')}/quillrank/*/ranker-*/model"
    before = set(glob.glob(models))
    result = entry.queries()["train_ranker"](spark, folder)
    (path,) = set(glob.glob(models)) - before
    whole = inspect.signature(train_ranker).parameters["n_estimators"].default
    run, stored = entry._run(spark, folder), GBTRegressionModel.load(path)
    assert run.ranker.model.getNumTrees == stored.getNumTrees == whole == 200
    assert min(tree.numNodes for tree in stored.trees) > 1
    assert result.count() == run.data.test.count() > 0


@pytest.mark.parametrize("name", ["rerank", "search"])
def test_two_stage_queries_come_in_the_order_of_the_model(spark, folder, name):
    got = [(r["query_id"], r["doc_id"]) for r in entry.queries()[name](spark, folder).collect()]
    run, candidates = entry._run(spark, folder), entry.bm25_topk(spark, folder)
    featured = build_features(candidates.drop("rank"), run.data.terms, add_bm25=False)
    scored = run.ranker.predict(featured).select("query_id", "doc_id", "bm25_score", F.round("model_score", 6).alias("s")).collect()
    assert got == [(r["query_id"], r["doc_id"]) for r in sorted(scored, key=lambda r: (r["query_id"], -r["s"], r["doc_id"]))]
    assert got != [(r["query_id"], r["doc_id"]) for r in sorted(scored, key=lambda r: (r["query_id"], -r["bm25_score"], r["doc_id"]))]


@pytest.mark.parametrize("name, table", [("rank_documents", "ranked-documents"), ("rank_record", "ranked-records")])
def test_ranked_lists_are_stored_with_rank_and_score(spark, folder, name, table):
    result = entry.queries()[name](spark, folder)
    got = defaultdict(list)
    for row in result.collect():
        got[row["query_id"]].append(row["document"])
    (path,) = {file.rsplit("/", 1)[0] for file in result.inputFiles()}
    assert f"/{table}-" in path and path.removeprefix("file://").startswith(work_folder(spark).removeprefix("file://"))
    stored = defaultdict(list)
    for row in spark.read.parquet(path).collect():
        stored[row["query_id"]].append((row["rank"], row["document"], round(row["model_score"], 6)))
    assert got and got == {key: [document for _, document, _ in sorted(rows)] for key, rows in stored.items()}
    for rows in stored.values():
        assert [score for _, _, score in sorted(rows)] == sorted((score for *_, score in rows), reverse=True)


def test_report_of_the_large_run_is_stored_whole(spark, folder):
    result = entry.train_large(spark, folder)
    (path,) = {file.rsplit("/", 1)[0] for file in result.inputFiles()}
    assert spark.read.parquet(path).first().asDict().keys() >= {"model_NDCG@10", "model_MRR", "model_MAP"}
    assert result.columns == ["rows_train", "rows_test"]


def test_fixed_scorer_decides_rank_and_score(spark, folder, monkeypatch):
    """The rows that SQL states depend on the scorer: other weights give other ranks."""
    rows = entry.search_linear(spark, folder).collect()
    for row in rows:
        better = [r for r in rows if r["query_id"] == row["query_id"] and (-r["model_score"], r["doc_id"]) < (-row["model_score"], row["doc_id"])]
        assert row["rank"] == len(better) + 1
    monkeypatch.setattr(entry.oracle, "LINEAR", {"doc_len": 1.0})
    other = {(r["query_id"], r["doc_id"]): (r["rank"], r["model_score"]) for r in entry.search_linear(spark, folder).collect()}
    assert other.keys() == {(r["query_id"], r["doc_id"]) for r in rows}
    assert any(other[r["query_id"], r["doc_id"]] != (r["rank"], r["model_score"]) for r in rows)
