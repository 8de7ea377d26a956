"""Training runs: split, fit, featurise, train, evaluate; ablation; the large-data run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.operators.features import build_features
from quillrank.operators.labels import cap_whole_queries, split_by_keys, split_by_query
from quillrank.operators.metrics import evaluate_scores, failures, ndcg_by_rank
from quillrank.operators.ranker import EVAL_AT, Ranker, train_ranker
from quillrank.operators.semantic import Encoder
from quillrank.operators.tfidf import save_terms, tfidf_fit
from quillrank.schemas import ALL_FEATURES, LEXICAL_FEATURES
from quillrank.session import materialise
from quillrank.sources.tables import log_experiment, read_experiments, scan_capped, write_json

# The nested feature sets of the ablation.
ABLATION_FEATURES = {
    "bm25_only": ["bm25_score"],
    "bm25_tfidf": ["bm25_score", "tfidf_cosine_sim"],
    "bm25_tfidf_overlap": ["bm25_score", "tfidf_cosine_sim", "overlap_count", "overlap_ratio"],
    "hybrid_full": ALL_FEATURES,
}
# The ranks at which NDCG is reported during and after large training.
LARGE_EVAL_AT = (1, 3, 5, 10)


@dataclass(frozen=True)
class FeaturedSplit:
    """Train and test rows with features, and the vocabulary fitted on train only."""

    train: DataFrame
    test: DataFrame
    terms: DataFrame


@dataclass(frozen=True)
class TrainingRun:
    ranker: Ranker
    data: FeaturedSplit
    scored_test: DataFrame
    metrics: DataFrame
    failures: DataFrame


def featurise_split(
    judgements: DataFrame,
    test_size: float = 0.25,
    seed: int = 42,
    test_keys: DataFrame | None = None,
    add_semantic: bool = True,
    encoder: Encoder | None = None,
    query_key: str = "query_id",
    doc_key: str | None = None,
    max_train_rows: int | None = None,
) -> FeaturedSplit:
    """Split by query, fit TF-IDF on the train side, build and store the features of both.

    ``max_train_rows`` keeps whole train queries up to that many rows; the test side is never cut.
    """
    if test_keys is None:
        train, test = split_by_query(judgements, test_size, seed, query_key)
    else:
        train, test = split_by_keys(judgements, test_keys, query_key)
    train = cap_whole_queries(train, max_train_rows, seed, query_key)
    terms = materialise(tfidf_fit(train), "tfidf-terms")

    def featured(rows: DataFrame, name: str) -> DataFrame:
        table = build_features(
            rows, terms, add_semantic=add_semantic, encoder=encoder, query_key=query_key, doc_key=doc_key
        )
        return materialise(table, name)

    return FeaturedSplit(featured(train, "train-featured"), featured(test, "test-featured"), terms)


def train_and_evaluate(
    data: FeaturedSplit,
    features: Sequence[str] | None = None,
    k: int = 5,
    tie: str = "doc_id",
    validate: bool = False,
    **training,
) -> TrainingRun:
    """Train on the train side; on the test side compare BM25 and the model at rank ``k``.

    With ``validate`` the test side is also measured after every round, which ``ranker.history`` keeps.
    Without, the model is constant if no train query has rows of different relevance; the test side is measured all the same.
    """
    validation = data.test if validate else None
    ranker = train_ranker(
        data.train, features or ALL_FEATURES, tie=tie, validation=validation, constant=not validate, **training
    )
    scored = materialise(ranker.predict(data.test), "test-scored")
    return TrainingRun(
        ranker,
        data,
        scored,
        evaluate_scores(scored, ["bm25_score", "model_score"], k, tie=tie),
        failures(scored, "model_score", tie=tie),
    )


def ndcg_at_ranks(scored: DataFrame, ranks: Sequence[int] = EVAL_AT, **options) -> DataFrame:
    """``(k, ndcg)`` of the model score for each rank."""
    return ndcg_by_rank(scored, "model_score", ranks, **options)


def ablation(
    data: FeaturedSplit,
    log_path: str,
    configs: dict[str, list[str]] | None = None,
    k: int = 5,
    **training,
) -> DataFrame:
    """Train and evaluate one ranker per feature set on the same stored features.

    Every run is appended to the experiment log. Gives ``(experiment, features, ndcg, mrr, map)``
    by NDCG.
    """
    spark = data.train.sparkSession
    rows = []
    for name, features in (configs or ABLATION_FEATURES).items():
        run = train_and_evaluate(data, features, k, **training)
        metrics = run.metrics.where(F.col("score") == "model_score").first().asDict()
        log_experiment(spark, log_path, name, features, metrics, notes=f"{len(features)} features")
        rows.append((name, ", ".join(features), metrics["ndcg"], metrics["mrr"], metrics["map"]))
    schema = "experiment STRING, features STRING, ndcg DOUBLE, mrr DOUBLE, map DOUBLE"
    return spark.createDataFrame(rows, schema).orderBy(F.col("ndcg").desc(), "experiment")


def experiment_log(spark: SparkSession, log_path: str) -> DataFrame:
    return read_experiments(spark, log_path)


def train_large(
    spark: SparkSession,
    path: str,
    max_rows: int | None = 1_500_000,
    use_semantic: bool = False,
    seed: int = 42,
    n_estimators: int = 300,
    learning_rate: float = 0.05,
    num_leaves: int = 63,
    min_data_in_leaf: int = 20,
    min_data_in_bin: int = 20,
    validate: bool = False,
    out: str | None = None,
) -> tuple[TrainingRun, DataFrame]:
    """The run on judgement shards: 0.2 test split, capped train side, lexical features, report.

    ``max_rows`` bounds the rows that the model is fitted on; all test rows are measured. With ``out`` the
    model, its terms, the featured rows and the report are stored below that path.
    The report row has the keys ``rows_train, rows_test`` and NDCG@10, MRR and MAP of both scores.
    """
    judgements = with_row_keys(scan_capped(spark, path))
    data = featurise_split(
        judgements, 0.2, seed, add_semantic=use_semantic, query_key="query_id", max_train_rows=max_rows
    )
    run = train_and_evaluate(
        data,
        ALL_FEATURES if use_semantic else LEXICAL_FEATURES,
        k=10,
        tie="row_key",
        n_estimators=n_estimators,
        learning_rate=learning_rate,
        num_leaves=num_leaves,
        min_data_in_leaf=min_data_in_leaf,
        min_data_in_bin=min_data_in_bin,
        validate=validate,
        eval_at=LARGE_EVAL_AT,
    )
    report = large_report(run)
    if out:
        save_run(run, out)
        write_json(report, f"{out}/report")
    return run, report


def with_row_keys(judgements: DataFrame) -> DataFrame:
    """Add ``row_key``, short and unique in a query: the text's hash and its occurrence among equal rows.

    Equal rows of a query are interchangeable, so it does not matter which of them comes first.
    """
    digest = F.md5("document")
    same = Window.partitionBy("query_id", "_digest").orderBy("relevance")
    numbered = judgements.withColumn("_digest", digest).withColumn("_nth", F.row_number().over(same))
    key = F.concat_ws("|", F.substring("_digest", 1, 16), F.lpad(F.col("_nth").cast("string"), 9, "0"))
    return numbered.withColumn("row_key", key).drop("_digest", "_nth")


def save_run(run: TrainingRun, path: str) -> None:
    """The model, the fitted terms and the featured rows of a run, for another session to load."""
    run.ranker.save(path)
    save_terms(run.data.terms, path)
    for name, rows in (("train", run.data.train), ("test", run.data.test)):
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/featured/{name}")


def large_report(run: TrainingRun) -> DataFrame:
    def value(score: str, metric: str):
        return run.metrics.where(F.col("score") == score).select(metric).scalar()

    names = {"ndcg": "NDCG@10", "mrr": "MRR", "map": "MAP"}
    return run.data.train.agg(F.count("*").cast("double").alias("rows_train")).select(
        "rows_train",
        run.data.test.agg(F.count("*").cast("double")).scalar().alias("rows_test"),
        *[
            value(f"{side}_score", metric).alias(f"{side}_{name}")
            for metric, name in names.items()
            for side in ("bm25", "model")
        ],
    )
