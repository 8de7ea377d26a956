import json
import pathlib

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillrank.operators.bm25 import bm25_retrieve
from quillrank.operators.judgements import build_judgements
from quillrank.operators.ranker import load_ranker
from quillrank.operators.tfidf import load_terms
from quillrank.plans import search as searching
from quillrank.plans import training
from quillrank.schemas import CATALOG, JUDGEMENT_SHARD, NESTED_RECORDS, QUERIES
from quillrank.session import new_work_path
from quillrank.sources import tables
from quillrank.streaming import jobs


@pytest.fixture(scope="module")
def run(spark, held_out):
    keys = spark.createDataFrame([("trail running shoes",)], "query_id STRING")
    data = training.featurise_split(held_out, test_keys=keys)
    return training.train_and_evaluate(data, n_estimators=3)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "gaming laptop"), (2, "wireless earbuds"), (3, "")], QUERIES)


def test_training_run(run):
    assert {r["score"] for r in run.metrics.collect()} == {"bm25_score", "model_score"}
    assert (run.data.train.count(), run.data.test.count()) == (17, 8)
    assert [r["k"] for r in training.ndcg_at_ranks(run.scored_test).collect()] == [1, 3, 5]


def test_search_reorders_candidates(queries, catalog_index, run):
    found = searching.search(queries, catalog_index, run.ranker, run.data.terms, 8)
    assert found.columns[:4] == ["query_id", "query", "rank", "doc_id"]
    stage_one = bm25_retrieve(queries, catalog_index, 8)
    key = ["query_id", "doc_id", "bm25_score"]
    assert rows_of(found.select(*key), *key) == rows_of(stage_one.select(*key), *key)
    for query_id in (1, 2, 3):
        scores = [r["model_score"] for r in found.where(F.col("query_id") == query_id).orderBy("rank").collect()]
        assert len(scores) == 8 and [round(s, 6) for s in scores] == sorted((round(s, 6) for s in scores), reverse=True)


def test_search_json(queries, catalog_index):
    rows = tables.search_json(bm25_retrieve(queries, catalog_index, 3)).where("query_id = 1").collect()
    response = json.loads(rows[0]["response"])
    assert response["query"] == "gaming laptop"
    assert [r["rank"] for r in response["results"]] == [1, 2, 3]
    assert response["results"][0]["document"] == "lenovo legion gaming laptop"


def test_rank_documents(spark, run):
    request = [(1, "office chair", ["mesh back adjustable office chair", "socks", "socks"]), (2, "x", [])]
    df = spark.createDataFrame(request, "query_id LONG, query STRING, documents ARRAY<STRING>")
    got = searching.rank_documents(df, run.ranker, run.data.terms)
    assert got.columns == ["query_id", "query", "rank", "document", "model_score"]
    assert sorted(r["rank"] for r in got.collect()) == [1, 2, 3]


def test_rank_record(spark, run):
    records = [
        (1, "gaming laptop", (["gaming mouse", "hp laptop", "gaming laptop", "sock"], [0, 0, 1, 0])),
        (2, "sock", (["sock", "gaming laptop"], [1, 0])),
    ]
    nested = spark.createDataFrame(records, NESTED_RECORDS)
    got = searching.rank_record(nested, run.ranker, run.data.terms, top_k=3)
    assert rows_of(got.groupBy("query_id").count(), "query_id") == [(1, 3), (2, 2)]
    other = searching.rank_record(nested, run.ranker, run.data.terms, query="laptop")
    assert {r["query"] for r in other.collect()} == {"laptop"}


def test_ablation_and_log(run, spark, tmp_path):
    log = str(tmp_path / "log")
    configs = {"a": ["bm25_score"], "b": ["bm25_score", "doc_len"]}
    summary = training.ablation(run.data, log, configs, n_estimators=2).collect()
    assert {row["experiment"] for row in summary} == {"a", "b"}
    assert [row["ndcg"] for row in summary] == sorted((row["ndcg"] for row in summary), reverse=True)
    tables.log_experiment(spark, log, "c", ["x", "y"], {"ndcg": 0.5}, "note")
    logged = rows_of(training.experiment_log(spark, log), "experiment_name")
    assert [row[0] for row in logged] == ["a", "b", "c"]
    assert logged[2] == ("c", "x,y", 0.5, 0.0, 0.0, "note")


def test_train_large(spark, held_out, tmp_path):
    path = str(tmp_path / "shards")
    shards = held_out.select(F.xxhash64("query").alias("query_id"), "query", "document", "relevance")
    tables.write_shards(shards, path)
    out = str(tmp_path / "run")
    run, report = training.train_large(spark, path, n_estimators=2, min_data_in_leaf=1, out=out)
    row = report.first().asDict()
    assert spark.read.json(f"{out}/report").first().asDict() == row
    for side, rows in (("train", run.data.train), ("test", run.data.test)):
        assert spark.read.parquet(f"{out}/featured/{side}").count() == rows.count()
    # what a server in another session needs
    request = spark.createDataFrame([(1, "office chair", ["mesh chair", "sock"])], "query_id LONG, query STRING, documents ARRAY<STRING>")
    loaded, terms = load_ranker(spark, out), load_terms(spark, out)
    again = searching.rank_documents(request, loaded, terms).orderBy("document").collect()
    assert again == searching.rank_documents(request, run.ranker, run.data.terms).orderBy("document").collect()
    with pytest.raises(FileNotFoundError, match="Run training first"):
        load_terms(spark, str(tmp_path / "nowhere"))
    assert row["rows_train"] + row["rows_test"] == 25
    assert set(row) == {
        "rows_train", "rows_test", "bm25_NDCG@10", "model_NDCG@10", "bm25_MRR", "model_MRR", "bm25_MAP", "model_MAP",
    }
    assert "semantic_cosine_sim" not in run.ranker.features
    tables.write_json(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 1


def test_train_cap_leaves_the_test_side_whole(spark, held_out, tmp_path):
    path = str(tmp_path / "shards")
    shards = held_out.select(F.xxhash64("query").alias("query_id"), "query", "document", "relevance")
    tables.write_shards(shards.unionByName(shards), path)  # every passage twice in its query
    run, _ = training.train_large(spark, path, max_rows=20, n_estimators=1, min_data_in_leaf=1)
    whole, _ = training.train_large(spark, path, max_rows=None, n_estimators=1, min_data_in_leaf=1)
    assert run.data.train.count() <= 20 < whole.data.train.count()
    assert run.data.test.count() == whole.data.test.count() > 0
    keys = whole.data.train.groupBy("query_id", "row_key").count()
    assert keys.where("count > 1").count() == 0


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(1, 'say "hi", twice', "a"), (2, "two\nlines", "b"), (3, None, "c")]
    tables.write_csv(spark.createDataFrame(rows, CATALOG), path)
    assert rows_of(tables.read_csv(spark, path, CATALOG, multiline=True), "doc_id") == rows
    tables.write_csv(spark.createDataFrame(rows[:1], CATALOG), path)
    assert rows_of(tables.read_csv(spark, path, CATALOG), "doc_id") == rows[:1]
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tables.read_csv(spark, str(tmp_path / "nowhere"), CATALOG)


def test_shards_and_metadata(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(i // 3, f"q{i // 3}", f"d{i}", 0) for i in range(10)]
    tables.write_shards(spark.createDataFrame(rows, JUDGEMENT_SHARD).coalesce(1), path, rows_per_shard=4)
    row = tables.dataset_metadata(spark, path, target="test").first()
    assert (row["rows_written"], row["queries_seen"], row["shards"], row["target"]) == (10, 4, 3, "test")
    assert row["bytes_written"] > 0
    assert tables.scan_capped(spark, path, None).count() == 10


def test_scan_without_shards_or_rows(spark, tmp_path):
    with pytest.raises(RuntimeError, match="No parquet shards"):
        tables.scan_capped(spark, str(tmp_path / "nowhere"))
    empty = str(tmp_path / "empty")
    tables.write_shards(spark.createDataFrame([], JUDGEMENT_SHARD), empty)
    with pytest.raises(RuntimeError, match="No rows"):
        tables.scan_capped(spark, empty)


RECORDS = [(i, f"query {i}", ([f"p{i}", f"n{i}"], [i % 2, 0])) for i in range(12)]


def test_judgement_stream_equals_batch_and_resumes(spark, tmp_path):
    source, sink, state = (str(tmp_path / name) for name in ("source", "sink", "state"))
    nested = spark.createDataFrame(RECORDS, NESTED_RECORDS)
    nested.where("query_id < 6").repartition(3).write.parquet(source)

    def drain():
        jobs.stream_judgements(spark, source, sink, state, max_files_per_trigger=1).awaitTermination()
        return rows_of(spark.read.parquet(sink), "query_id", "document")

    def batch(part):
        return rows_of(build_judgements(part), "query_id", "document")

    assert drain() == batch(nested.where("query_id < 6"))
    assert drain() == batch(nested.where("query_id < 6"))
    nested.where("query_id >= 6").write.mode("append").parquet(source)
    assert drain() == batch(nested)


def test_query_stream_equals_batch(spark, queries, catalog_index, run, tmp_path):
    source = str(tmp_path / "queries")
    queries.repartition(3).write.parquet(source)

    def answers(name, answer):
        sink, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        for _ in range(2):
            jobs.stream_queries(spark, source, sink, state, answer, max_files_per_trigger=1).awaitTermination()
        return jobs.read_answers(spark, sink)

    stage_one = answers("retrieved", jobs.retrieval(catalog_index, 4))
    assert rows_of(stage_one, "query_id", "rank") == rows_of(bm25_retrieve(queries, catalog_index, 4), "query_id", "rank")
    folder = pathlib.Path(new_work_path(spark, "x")).parent
    before = set(folder.iterdir())
    full = answers("searched", jobs.two_stage(catalog_index, run.ranker, run.data.terms, 4))
    assert set(folder.iterdir()) == before  # batches leave no working tables
    batch = searching.search(queries, catalog_index, run.ranker, run.data.terms, 4)
    assert rows_of(full, "query_id", "rank") == rows_of(batch, "query_id", "rank")
