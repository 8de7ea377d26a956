import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillrank.operators.metrics import evaluate
from quillrank.operators.ranker import (
    _newton_steps,
    _training_rows,
    _whole_queries,
    feature_importance,
    load_ranker,
    pulls,
    train_ranker,
)

FEATURES = ["signal", "noise"]


@pytest.fixture(scope="module")
def featured(spark):
    rng = random.Random(3)
    rows = []
    for q in range(12):
        for d in range(rng.randint(4, 14)):
            grade = rng.choice([0, 0, 1, 3])
            rows.append((f"q{q}", d, grade, grade + rng.gauss(0, 0.8), rng.random()))
    rows += [("flat", d, 1, 0.5, 0.5) for d in range(3)]
    schema = "query_id STRING, doc_id LONG, relevance INT, signal DOUBLE, noise DOUBLE"
    return spark.createDataFrame(rows, schema).persist()


def brute_steps(rows, truncation):
    """Sums of gradient and curvature per row over all pairs, scores all equal to ``signal``."""
    groups = {}
    for q, d, grade, score in rows:
        groups.setdefault(q, []).append((d, 2.0**grade - 1, score))
    steps = {}
    for q, group in groups.items():
        order = sorted(group, key=lambda r: (-round(r[2], 6), r[0]))
        discount = [1 / math.log2(p + 2) if p < truncation else 0.0 for p in range(len(order))]
        ideal = sum(g / math.log2(p + 2) for p, g in enumerate(sorted((r[1] for r in group), reverse=True)[:truncation]))
        for i, (d, gain, score) in enumerate(order):
            for j, (other, other_gain, other_score) in enumerate(order):
                if gain == other_gain or (i >= truncation and j >= truncation):
                    continue
                change = abs(gain - other_gain) * abs(discount[i] - discount[j]) / ideal
                sign = 1.0 if gain > other_gain else -1.0
                doubt = 1 / (1 + math.exp(sign * (score - other_score)))
                g, h = steps.get((q, d), (0.0, 0.0))
                steps[q, d] = (g + sign * doubt * change, h + doubt * (1 - doubt) * change)
    return steps


@pytest.mark.parametrize(("truncation", "hot_rows"), [(30, 1000), (3, 1000), (3, 4)])
def test_newton_steps_equal_brute_force(featured, truncation, hot_rows):
    data, largest = _training_rows(featured, FEATURES, truncation, "query_id", "doc_id", hot_rows)
    scores = featured.select(F.col("query_id").alias("query"), F.col("doc_id").alias("row"), F.col("signal").alias("score"))
    steps = _newton_steps(data.join(scores, ["query", "row"]), truncation, largest > truncation)
    got = {(r["query"], r["row"]): (r["gradient"], r["curvature"]) for r in steps.collect()}
    for r in steps.collect():  # so that a leaf is the sum of gradients over the sum of curvatures
        assert r["target"] * r["curvature"] == pytest.approx(r["gradient"], abs=1e-9)
    rows = [(r["query_id"], r["doc_id"], r["relevance"], r["signal"]) for r in featured.collect()]
    expected = {key: value for key, value in brute_steps(rows, truncation).items() if value[1] > 0}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-9)
    totals = {}
    for (q, _), (g, _) in got.items():
        totals[q] = totals.get(q, 0.0) + g
    assert all(abs(total) < 1e-9 for total in totals.values())


@pytest.mark.parametrize("truncation", [30, 3])
def test_pulls_of_whole_queries_equal_brute_force(featured, truncation, monkeypatch):
    monkeypatch.setattr("quillrank.operators.ranker.PAIRED_ROWS", 7)
    rows = sorted((r["query_id"], r["doc_id"], r["relevance"], r["signal"]) for r in featured.collect())
    grades = {}
    for q, _, grade, _ in rows:
        grades.setdefault(q, []).append(2.0**grade - 1)
    ideal = {q: sum(g / math.log2(p + 2) for p, g in enumerate(sorted(own, reverse=True)[:truncation])) for q, own in grades.items()}
    first = np.array([i == 0 or rows[i - 1][0] != row[0] for i, row in enumerate(rows)])
    gain = np.array([2.0 ** row[2] - 1 for row in rows])
    gradient, curvature = pulls(first, gain, np.array([1 / ideal[row[0]] for row in rows]), np.array([row[3] for row in rows]), truncation)
    got = {row[:2]: (g, h) for row, g, h in zip(rows, gradient, curvature) if h > 0}
    expected = {key: value for key, value in brute_steps(rows, truncation).items() if value[1] > 0}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-9)


def test_an_absent_relevance_pulls_nothing():
    first, score = np.array([True, False, False]), np.zeros(3)
    gradient, curvature = pulls(first, np.array([1.0, np.nan, 0.0]), np.ones(3), score, 30)
    assert gradient[1] == curvature[1] == 0 and gradient[0] == -gradient[2] > 0


@pytest.mark.parametrize("size", [1, 2, 5, 9])
def test_batches_are_cut_between_queries_only(size):
    first = [True, False, False, True, True, False, False, False, True]
    whole = pa.RecordBatch.from_arrays([pa.array(first), pa.array(range(9))], ["first", "n"])
    parts = list(_whole_queries(iter([whole.slice(0, 0), *[whole.slice(i, size) for i in range(0, 9, size)]])))
    assert [n for part in parts for n in part["n"].to_pylist()] == list(range(9))
    assert all(part["first"][0].as_py() for part in parts)


def test_learns_saves_and_explains(spark, featured, tmp_path):
    ranker = train_ranker(featured, FEATURES, n_estimators=6, learning_rate=0.3, num_leaves=8, checkpoint_every=2)
    scored = ranker.predict(featured)
    learned = evaluate(scored, "model_score", 5).first()["ndcg"]
    assert learned >= max(evaluate(featured, name, 5).first()["ndcg"] for name in FEATURES)

    path = str(tmp_path / "ranker")
    ranker.save(path)
    loaded = load_ranker(spark, path)
    assert loaded.features == FEATURES
    assert rows_of(loaded.predict(featured), "query_id", "doc_id") == rows_of(scored, "query_id", "doc_id")

    importance = feature_importance(ranker).collect()
    assert [row["feature"] for row in importance] == FEATURES
    assert importance[0]["gain_importance"] > importance[1]["gain_importance"]
    assert sum(row["split_importance"] for row in importance) > 0


def test_hot_query_gives_the_same_model(featured):
    def scores(**options):
        ranker = train_ranker(featured, FEATURES, n_estimators=2, truncation=3, **options)
        rounded = ranker.predict(featured).withColumn("model_score", F.round("model_score", 9))
        return rows_of(rounded, "query_id", "doc_id")

    assert scores() == scores(hot_rows=3)


def test_nothing_to_learn(featured):
    with pytest.raises(ValueError, match="different relevance"):
        train_ranker(featured.where("query_id = 'flat'"), FEATURES)


def test_nothing_to_learn_can_give_a_constant_model(spark, featured, tmp_path):
    flat, path = featured.where("query_id = 'flat'"), str(tmp_path / "constant")
    with pytest.warns(UserWarning, match="the model is constant"):
        ranker = train_ranker(flat, FEATURES, constant=True)
    ranker.save(path)
    loaded = load_ranker(spark, path)
    assert loaded.model.getNumTrees == 1 and {r["model_score"] for r in loaded.predict(featured).collect()} == {0.0}
    assert [r["split_importance"] for r in feature_importance(ranker).collect()] == [0, 0]


def test_missing_feature_and_model(spark, featured, tmp_path):
    with pytest.raises(ValueError, match=r"\['absent'\]"):
        train_ranker(featured, ["signal", "absent"])
    with pytest.raises(FileNotFoundError, match="Run training first"):
        load_ranker(spark, str(tmp_path / "nowhere"))
