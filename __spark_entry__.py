
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle
from quillrank.functions.text import clean_text, tokens, with_clean_texts
from quillrank.operators import bm25, judgements, labels, metrics, semantic, tfidf
from quillrank.operators.features import build_features, lexical_features
from quillrank.operators.ranker import LinearScorer, feature_importance, gradients, load_ranker
from quillrank.plans import search as searching
from quillrank.plans import training
from quillrank.schemas import ALL_FEATURES
from quillrank.session import materialise, new_work_path
from quillrank.sources import tables
from quillrank.streaming import jobs

try:  # the only place that knows whether the training-data subpackage is there
    import corpus_pipeline
    from quillrank.llm import queries as llm_queries
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "quillrank.llm"):
        raise  # it is there, but something that it needs is not
    corpus_pipeline = llm_queries = None

# Boosting rounds of the large run; the history and the ablation take half as many. The library's own defaults
# are 300 and 200; the model of `_run` has all of them.
ROUNDS = 10
FOUND = ["query_id", "query", "doc_id", "document", "category", "bm25_score"]
SMALL = "/root/testdata/sf0.001"

_stored: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Artefacts several queries start from, such as the index, are built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


# --------------------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("document"), F.col("source").alias("category")
    )


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _index(spark: SparkSession, sf_dir: str) -> bm25.Bm25Index:
    return _once(spark, sf_dir, "index", lambda: bm25.build_index(_corpus(spark, sf_dir)))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded documents: 3 if one holds the whole passage, 1 if half its tokens, else 0.

    The candidates are the best by BM25 and every other document that holds the passage, in ``doc_id`` order.
    """

    def make() -> DataFrame:
        queries, index = _queries(spark, sf_dir), _index(spark, sf_dir)
        best = bm25.bm25_retrieve(queries, index, oracle.TOP_K)
        best = materialise(best.select("query_id", "query", "rank", "doc_id", "document"), "best")
        holding = bm25.containing_ids(queries, index).join(best, ["query_id", "doc_id"], "left_anti")
        after = Window.partitionBy("query_id").orderBy("doc_id")
        holding = holding.withColumn("rank", F.row_number().over(after) + oracle.TOP_K)
        holding = holding.join(queries, "query_id").join(index.docs.select("doc_id", "document"), "doc_id")
        found = best.unionByName(holding)
        grade = F.when(F.col("exact_match") == 1, 3).when(F.col("overlap_ratio") >= 0.5, 1).otherwise(0)
        graded = lexical_features(found).withColumn("relevance", grade)
        return materialise(
            graded.select("query_id", "query", "rank", "doc_id", "document", "relevance"), "judged"
        )

    return _once(spark, sf_dir, "judged", make)


def _judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).drop("rank")


def _nested(spark: SparkSession, sf_dir: str) -> str:
    """Path of nested records made from the graded candidates, in several files."""

    def make() -> str:
        path = new_work_path(spark, "nested")
        judgements.nest_candidates(_judged(spark, sf_dir)).repartition(4).write.parquet(path)
        return path

    return _once(spark, sf_dir, "nested", make)


def _shards(spark: SparkSession, sf_dir: str) -> str:
    """Path of judgement shards holding every graded candidate."""

    def make() -> str:
        path = new_work_path(spark, "shards")
        tables.write_shards(
            _judgements(spark, sf_dir).select("query_id", "query", "document", "relevance"), path
        )
        return path

    return _once(spark, sf_dir, "shards", make)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "scored",
        lambda: materialise(bm25.bm25_group_score(_judgements(spark, sf_dir)), "scored"),
    )


def _featured(spark: SparkSession, sf_dir: str) -> training.FeaturedSplit:
    return _once(
        spark, sf_dir, "featured", lambda: training.featurise_split(_judgements(spark, sf_dir))
    )


def _run(spark: SparkSession, sf_dir: str) -> training.TrainingRun:
    return _once(
        spark,
        sf_dir,
        "run",
        lambda: training.train_and_evaluate(_featured(spark, sf_dir)),
    )


def _large(spark: SparkSession, sf_dir: str) -> tuple[training.TrainingRun, DataFrame]:
    return _once(
        spark,
        sf_dir,
        "large",
        lambda: training.train_large(spark, _shards(spark, sf_dir), n_estimators=ROUNDS),
    )


def _specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query specifications: the ids graded 3 and 1."""

    def ids(grade: int):
        return F.collect_list(F.when(F.col("relevance") == grade, F.col("doc_id")))

    return (
        _judgements(spark, sf_dir)
        .groupBy("query_id", "query")
        .agg(ids(3).alias("positives"), ids(1).alias("semi_relevant"))
    )


def _labels_and_hard(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def make() -> tuple[DataFrame, DataFrame]:
        marked = materialise(labels.labelled_ids(_specs(spark, sf_dir)), "labels")
        hard = labels.hard_negative_ids(
            _queries(spark, sf_dir), marked, _index(spark, sf_dir), oracle.DEEP_K
        )
        return marked, materialise(hard, "hard")

    return _once(spark, sf_dir, "labels", make)


def _used(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, hard = _labels_and_hard(spark, sf_dir)
    return marked.select("query_id", "doc_id").unionByName(hard).distinct()


# --------------------------------------------------------------------------- queries


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    path = new_work_path(spark, "part-csv")
    tables.write_csv(part, path)
    return (
        tables.read_csv(spark, path, part.schema)
        .groupBy("p_type")
        .agg(
            F.count("*").alias("n"),
            F.sum("p_size").alias("sizes"),
            F.min("p_name").alias("first_name"),
            F.max("p_brand").alias("last_brand"),
        )
    )


def scan_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_capped(spark, _shards(spark, sf_dir), oracle.CAPPED_ROWS)


def build_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgements.build_judgements(tables.read_nested(spark, _nested(spark, sf_dir)))


def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "judgement-shards")
    tables.write_shards(build_judgements(spark, sf_dir), path)
    metadata = tables.dataset_metadata(
        spark, path, max_negatives_per_query=judgements.MAX_NEGATIVES
    )
    tables.write_json(metadata, new_work_path(spark, "metadata"))
    return metadata.select("rows_written", "queries_seen", "max_negatives_per_query")


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.bm25_retrieve(_queries(spark, sf_dir), _index(spark, sf_dir), oracle.TOP_K)


def bm25_topk_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    catalog = part.select(
        F.col("p_partkey").alias("doc_id"),
        F.col("p_name").alias("document"),
        F.col("p_type").alias("category"),
    )
    index = _once(spark, sf_dir, "parts", lambda: bm25.build_index(catalog))
    names = part.groupBy(F.col("p_name").alias("query")).agg(F.min("p_partkey").alias("query_id"))
    return bm25.bm25_retrieve(names, index, oracle.TOP_K)


def search_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.search_json(bm25_topk(spark, sf_dir), ["rank", "doc_id"])


def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir).select("doc_id", clean_text(F.col("document")).alias("text_clean"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens(clean_text(F.col("document")))
    return _corpus(spark, sf_dir).select("doc_id", F.posexplode(words).alias("place", "token"))


def feature_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_features(_judgements(spark, sf_dir)).select("query_id", "doc_id", "query_len", "doc_len")


def feature_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_features(_judgements(spark, sf_dir)).select(
        "query_id", "doc_id", "overlap_count", F.round("overlap_ratio", 6).alias("overlap_ratio")
    )


def feature_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_features(_judgements(spark, sf_dir)).select("query_id", "doc_id", "exact_match")


def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.postings_table(_corpus(spark, sf_dir)).where(F.col("token") != bm25.EVERY_DOC)


def bm25_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).terms.select("token", "df", F.round("idf", 6).alias("idf"))


def bm25_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.bm25_group_score(_judgements(spark, sf_dir)).select("query_id", "doc_id", "bm25_score")


def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.tfidf_fit(_judgements(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


def tfidf_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.tfidf_cosine(_judgements(spark, sf_dir)).select("query_id", "doc_id", "tfidf_cosine_sim")


def semantic_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")

    def keyed(name: str) -> DataFrame:
        return vectors.select(F.col("vec_id").alias(name), F.col("embedding").alias("vector"))

    pairs = semantic.semantic_cosine(_judgements(spark, sf_dir), keyed("query_id"), keyed("doc_id"))
    return pairs.select("query_id", "doc_id", "semantic_cosine_sim")


def text_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = semantic.text_embed(_corpus(spark, sf_dir), "document")
    coordinates = embedded.select("doc_id", F.posexplode("vector").alias("dimension", "x")).where("x <> 0")
    return coordinates.select("doc_id", "dimension", F.round("x", 6).alias("value"))


def text_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_clean_texts(_judgements(spark, sf_dir))
    return semantic.with_text_similarity(pairs).select("query_id", "doc_id", "semantic_cosine_sim")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(_judgements(spark, sf_dir)).select(
        "query_id", "doc_id", "relevance", *ALL_FEATURES
    ).withColumn("overlap_ratio", F.round("overlap_ratio", 6))


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_lookup(_specs(spark, sf_dir), _corpus(spark, sf_dir))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, _ = _labels_and_hard(spark, sf_dir)
    return labels.hard_negative_ids(
        _queries(spark, sf_dir), marked, _index(spark, sf_dir), oracle.DEEP_K
    )


def random_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.random_negative_ids(
        _queries(spark, sf_dir), _used(spark, sf_dir), _corpus(spark, sf_dir)
    )


def unused_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.unused_docs(_corpus(spark, sf_dir).select("doc_id"), _used(spark, sf_dir))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.build_training_set(
        _specs(spark, sf_dir), _corpus(spark, sf_dir), _index(spark, sf_dir), oracle.DEEP_K
    )


def dedup_max_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    deep = bm25.bm25_top_ids(_queries(spark, sf_dir), _index(spark, sf_dir), oracle.DEEP_K)
    graded = _judgements(spark, sf_dir).select("query_id", "doc_id", "relevance")
    return labels.dedup_max_relevance(
        graded.unionByName(deep.select("query_id", "doc_id", F.lit(0).alias("relevance")))
    )


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.group_sizes(_judgements(spark, sf_dir))


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_distribution(_judgements(spark, sf_dir))


def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judgements(spark, sf_dir).select("query_id", "doc_id", "relevance")
    train, test = labels.split_by_query(rows)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def ranked_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ranked_listing(_scored(spark, sf_dir), "bm25_score").select(
        "query_id", "doc_id", "relevance", "bm25_score", "rank", "hits"
    )


def precision_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.precision_curve(_scored(spark, sf_dir), "bm25_score").select(
        "query_id", "doc_id", "rank", "hits", "precision"
    )


def eval_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.evaluate_per_query(_scored(spark, sf_dir), "bm25_score", 5)


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.evaluate(_scored(spark, sf_dir), "bm25_score", 5)


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.failures(_scored(spark, sf_dir), "bm25_score")


def ranker_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair gradients and curvatures of all judged rows, ranked by BM25."""
    pulls = gradients(_scored(spark, sf_dir), "bm25_score").select(
        "query_id", "doc_id", F.round("gradient", 6).alias("gradient"), F.round("curvature", 6).alias("curvature")
    )
    return pulls.where(F.col("curvature") > 0)


def training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDCG of the held-out queries after each round, at the ranks of the evaluation."""

    def make() -> DataFrame:
        run = training.train_and_evaluate(_featured(spark, sf_dir), n_estimators=ROUNDS // 2, validate=True)
        return run.ranker.history_table()

    return _once(spark, sf_dir, "history", make)


def train_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, store and load the model, then score the test rows with it; the scores are tested apart."""
    run = _run(spark, sf_dir)
    path = new_work_path(spark, "ranker")
    run.ranker.save(path)
    scored = load_ranker(spark, path).predict(run.data.test).where(F.col("model_score").isNotNull())
    return scored.select("query_id", "doc_id", "relevance", "bm25_score")


# What a model's score decides is checked by pytest. The queries below compute and store it, and return what
# SQL can state too; their rows come in the order of the model.


def ndcg_at_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir).withColumn("model_score", F.col("bm25_score"))
    return training.ndcg_at_ranks(scored, training.LARGE_EVAL_AT)


def _ordered(ranked: DataFrame, name: str) -> DataFrame:
    """The whole result with rank and score, stored before it is projected, in the order of the ranks.

    Without the stored table Spark would prune the model from a projection that leaves its columns out.
    """
    return materialise(ranked, name).orderBy("query_id", "rank")


def _reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    candidates = materialise(bm25_topk(spark, sf_dir), "candidates")
    return _ordered(searching.rerank(candidates, run.ranker, run.data.terms), "reranked")


def rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reranked(spark, sf_dir).select(*FOUND)


def _searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    found = searching.search(
        _queries(spark, sf_dir), _index(spark, sf_dir), run.ranker, run.data.terms, oracle.TOP_K
    )
    return _ordered(found, "searched")


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _searched(spark, sf_dir).select(*FOUND)


def _ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    requests = tables.read_nested(spark, _nested(spark, sf_dir)).select(
        "query_id", "query", F.col("passages.passage_text").alias("documents")
    )
    return _ordered(searching.rank_documents(requests, run.ranker, run.data.terms), "ranked-documents")


def rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_documents(spark, sf_dir).select("query_id", "query", "document")


def search_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages with a fixed scorer, so that rank and score can be stated in SQL as well."""
    scorer = LinearScorer(oracle.LINEAR)
    found = searching.search(
        _queries(spark, sf_dir), _index(spark, sf_dir), scorer, tfidf.tfidf_fit(_judgements(spark, sf_dir)), oracle.TOP_K
    )
    return found.select("query_id", "rank", "doc_id", "bm25_score", "model_score")


def rank_documents_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of each record ranked by the fixed scorer, with BM25 among them."""
    requests = tables.read_nested(spark, _nested(spark, sf_dir)).select(
        "query_id", "query", F.col("passages.passage_text").alias("documents")
    )
    scorer = LinearScorer(oracle.LINEAR)
    ranked = searching.rank_documents(requests, scorer, tfidf.tfidf_fit(_judgements(spark, sf_dir)))
    return ranked.select("query_id", "document", "rank", "model_score")


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_importance(_run(spark, sf_dir).ranker)


def _ablation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    def make() -> tuple[DataFrame, str]:
        log = new_work_path(spark, "experiments")
        return training.ablation(_featured(spark, sf_dir), log, n_estimators=ROUNDS // 2), log

    return _once(spark, sf_dir, "ablation", make)


def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ablation(spark, sf_dir)[0].select("experiment", "features")


def experiment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = training.experiment_log(spark, _ablation(spark, sf_dir)[1])
    return logged.select("experiment_name", "features", "notes")


def train_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = materialise(_large(spark, sf_dir)[1], "large-report")  # with NDCG, MRR and MAP of both scores
    return report.select(*[F.col(c).cast("long").alias(c) for c in ("rows_train", "rows_test")])


def _ranked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = _large(spark, sf_dir)
    nested = tables.read_nested(spark, _nested(spark, sf_dir))
    return _ordered(searching.rank_record(nested, run.ranker, run.data.terms, oracle.TOP_K), "ranked-records")


def rank_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_records(spark, sf_dir).select("query_id", "query", "document", "bm25_score")


def stream_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_work_path(spark, "stream-judgements")
    jobs.stream_judgements(
        spark, _nested(spark, sf_dir), sink, new_work_path(spark, "stream-state"), max_files_per_trigger=2
    ).awaitTermination()
    return spark.read.parquet(sink)


def stream_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink = new_work_path(spark, "stream-queries"), new_work_path(spark, "stream-answers")
    _queries(spark, sf_dir).repartition(4).write.parquet(source)
    jobs.stream_queries(
        spark,
        source,
        sink,
        new_work_path(spark, "stream-state"),
        jobs.retrieval(_index(spark, sf_dir), oracle.TOP_K),
        max_files_per_trigger=2,
    ).awaitTermination()
    return jobs.read_answers(spark, sink)


def stream_search_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    source, sink = new_work_path(spark, "stream-queries"), new_work_path(spark, "stream-answers")
    _queries(spark, sf_dir).repartition(2).write.parquet(source)
    jobs.stream_queries(
        spark,
        source,
        sink,
        new_work_path(spark, "stream-state"),
        jobs.two_stage(_index(spark, sf_dir), run.ranker, run.data.terms, oracle.TOP_K),
        max_files_per_trigger=2,
    ).awaitTermination()
    return jobs.read_answers(spark, sink).select(*FOUND)


def entry(spark: SparkSession) -> DataFrame:
    """Two-stage search for every benchmark passage over all documents, with rank and model score."""
    return _searched(spark, SMALL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = {
        "scan_csv": scan_csv,
        "scan_capped": scan_capped,
        "dataset_metadata": dataset_metadata,
        "search_json": search_json,
        "clean_text": clean_texts,
        "tokenize": tokenize,
        "feature_lengths": feature_lengths,
        "feature_overlap": feature_overlap,
        "feature_exact_match": feature_exact_match,
        "bm25_index": bm25_index,
        "bm25_terms": bm25_terms,
        "bm25_topk": bm25_topk,
        "bm25_topk_catalog": bm25_topk_catalog,
        "bm25_group": bm25_group,
        "tfidf_terms": tfidf_terms,
        "tfidf_cosine": tfidf_cosine,
        "semantic_cosine": semantic_cosine,
        "text_embed": text_embed,
        "text_similarity": text_similarity,
        "build_features": features,
        "label_lookup": label_lookup,
        "hard_negatives": hard_negatives,
        "random_negatives": random_negatives,
        "unused_docs": unused_docs,
        "training_set": training_set,
        "dedup_max_relevance": dedup_max_relevance,
        "group_sizes": group_sizes,
        "label_distribution": label_distribution,
        "group_split": group_split,
        "ranked_listing": ranked_listing,
        "precision_curve": precision_curve,
        "eval_per_query": eval_per_query,
        "eval_metrics": eval_metrics,
        "ndcg_at_ranks": ndcg_at_ranks,
        "failures": failures,
        "ranker_gradients": ranker_gradients,
        "training_history": training_history,
        "train_ranker": train_ranker,
        "rerank": rerank,
        "search": search,
        "rank_documents": rank_documents,
        "search_linear": search_linear,
        "rank_documents_linear": rank_documents_linear,
        "feature_importance": importance,
        "ablation": ablation,
        "experiment_log": experiment_log,
        "build_judgements": build_judgements,
        "train_large": train_large,
        "rank_record": rank_record,
        "stream_judgements": stream_judgements,
        "stream_search": stream_search,
        "stream_search_two_stage": stream_search_two_stage,
    }
    if llm_queries is not None:
        registered |= llm_queries.queries()
        registered["pipeline"] = corpus_pipeline.run
    return registered


def oracle_sql() -> dict[str, str]:
    stated = oracle.statements()
    if llm_queries is not None:
        stated |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            stated["pipeline"] = corpus_pipeline.ORACLE_SQL
    return stated
