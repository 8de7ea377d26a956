"""Best-first trees from histograms against plain growth; validation while boosting."""

import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillrank.operators.metrics import evaluate, ndcg_by_rank
from quillrank.operators.ranker import train_ranker
from quillrank.operators.trees import best_split, bin_edges, grow, with_bins

FEATURES = ["a", "b", "c"]


def step_rows(n, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.randint(0, 9), draw.choice([0.0, 0.5, 2.5]), draw.gauss(0, 1)
        target = (a > 4) * 2 - (b > 0.2) * (c > 0) + draw.gauss(0, 0.3)
        weight = draw.uniform(0.1, 2)
        rows.append((float(a), b, c, target * weight, weight))
    return rows


def steps_of(spark, rows, max_bins=255, min_data_in_bin=1):
    table = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, gradient DOUBLE, curvature DOUBLE").repartition(3)
    edges = bin_edges(table, FEATURES, max_bins, min_data_in_bin)
    values = table.select(F.array(*FEATURES).alias("_values"), "gradient", "curvature")
    return with_bins(values, "_values", edges), edges


def gain_of(rows, keep):
    left = [r for r in rows if keep(r)]
    right = [r for r in rows if not keep(r)]
    if not left or not right:
        return -1.0

    def score(part):
        return sum(r[3] for r in part) ** 2 / sum(r[4] for r in part)

    return score(left) + score(right) - score(rows)


def plain_tree(rows, edges, num_leaves, least):
    """Sorted (rows, gradient, curvature) of the leaves: the leaf of the highest gain is split next."""

    def best(part):
        found = (1e-9, None)
        for f, own in enumerate(edges):
            for edge in own:
                sides = sum(r[f] <= edge for r in part)
                gain = gain_of(part, lambda r, f=f, edge=edge: r[f] <= edge)
                if least <= sides <= len(part) - least and gain > found[0] + 1e-9:
                    found = (gain, (f, edge))
        return found

    leaves = [(rows, best(rows))]
    while len(leaves) < num_leaves:
        at = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
        part, (_, split) = leaves[at]
        if split is None:
            break
        f, edge = split
        halves = [[r for r in part if r[f] <= edge], [r for r in part if r[f] > edge]]
        leaves[at : at + 1] = [(half, best(half)) for half in halves]
    return sorted((len(p), round(sum(r[3] for r in p), 6), round(sum(r[4] for r in p), 6)) for p, _ in leaves)


def leaves_of(tree):
    return sorted((n.n, round(n.g, 6), round(n.h, 6)) for n in tree.nodes if n.feature < 0)


def test_a_stump_equals_brute_force(spark):
    rows = step_rows(120, 1)
    steps, edges = steps_of(spark, rows)
    tree = grow(steps, [len(own) + 1 for own in edges], 2)
    root = tree.nodes[0]
    gains = [
        (gain_of(rows, lambda r, f=f, edge=edge: r[f] <= edge), f, edge) for f, own in enumerate(edges) for edge in own
    ]
    gain, feature, edge = max(gains, key=lambda g: g[0])
    assert root.gain == pytest.approx(gain) and (root.feature, edges[root.feature][root.bin]) == (feature, edge)
    left = [r for r in rows if r[feature] <= edge]
    assert tree.nodes[root.left].value == pytest.approx(sum(r[3] for r in left) / sum(r[4] for r in left))


@pytest.mark.parametrize(("num_leaves", "least"), [(5, 1), (13, 1), (9, 8)])
def test_exactly_num_leaves_best_first(spark, num_leaves, least):
    rows = step_rows(150, 2)
    steps, edges = steps_of(spark, rows, max_bins=20)
    tree = grow(steps, [len(own) + 1 for own in edges], num_leaves, least)
    assert tree.leaves() == num_leaves
    assert leaves_of(tree) == plain_tree(rows, edges, num_leaves, least)
    bins = np.array([row["bins"] for row in steps.collect()])
    ends, counts = np.unique(tree.nodes_of(bins), return_counts=True)
    assert sorted(counts) == sorted(n.n for n in tree.nodes if n.feature < 0) and len(ends) == num_leaves


def test_no_split_that_gains_nothing(spark):
    flat = [(1.0, 2.0, 3.0, 1.0, 1.0)] * 10
    steps, edges = steps_of(spark, flat)
    assert edges == [[], [], []]
    tree = grow(steps, [1, 1, 1], 31)
    assert tree.leaves() == 1 and tree.nodes[0].value == 1.0
    same = [(float(i), 2.0, 3.0, 1.0, 1.0) for i in range(10)]  # all targets equal
    steps, edges = steps_of(spark, same)
    assert grow(steps, [len(own) + 1 for own in edges], 31).leaves() == 1
    assert grow(steps.limit(0), [len(own) + 1 for own in edges], 31).leaves() == 1


def test_bins_hold_enough_rows(spark):
    rows = step_rows(400, 3)
    steps, edges = steps_of(spark, rows, min_data_in_bin=50)
    bins = np.array([row["bins"] for row in steps.collect()])
    for i, own in enumerate(edges):
        counts = np.bincount(bins[:, i], minlength=len(own) + 1)
        assert counts.min() >= 50 and len(own) >= 1
    for i, own in enumerate(edges):  # a row's bin is the number of edges below its value
        got = sorted(zip([row[i] for row in rows], [sum(edge < row[i] for edge in own) for row in rows]))
        assert sorted(bins[:, i]) == sorted(b for _, b in got)


def test_best_split_of_equal_gains_is_the_first():
    histogram = np.array([[1.0, 1.0, 1], [-1.0, 1.0, 1], [1.0, 1.0, 1], [-1.0, 1.0, 1]])
    assert best_split(histogram, [2, 2], 1)[1:3] == (0, 0)
    assert best_split(histogram, [2, 2], 2)[1] == -1


@pytest.fixture(scope="module")
def judged(spark):
    draw = random.Random(4)
    rows = []
    for q in range(24):
        for d in range(draw.randint(4, 12)):
            grade = draw.choice([0, 0, 1, 3])
            rows.append((f"q{q:02}", d, grade, grade + draw.gauss(0, 1.0), draw.random()))
    schema = "query_id STRING, doc_id LONG, relevance INT, signal DOUBLE, noise DOUBLE"
    return spark.createDataFrame(rows, schema).persist()


def test_history_equals_a_recomputation(judged):
    train, held = judged.where("query_id < 'q16'"), judged.where("query_id >= 'q16'")
    options = dict(features=["signal", "noise"], learning_rate=0.3, num_leaves=6, checkpoint_every=2)
    ranker = train_ranker(train, n_estimators=3, validation=held, eval_at=(1, 3, 5), **options)
    assert [entry[:2] for entry in ranker.history] == [(r, k) for r in (1, 2, 3) for k in (1, 3, 5)]
    for rounds in (1, 3):
        again = train_ranker(train, n_estimators=rounds, **options).predict(held)
        for number, k, ndcg in ranker.history:
            if number == rounds:
                assert ndcg == evaluate(again, "model_score", k).first()["ndcg"]
    assert rows_of(ranker.history_table(), "round", "k") == list(ranker.history)


def test_stops_when_nothing_rises(judged):
    train, held = judged.where("query_id < 'q16'"), judged.where("query_id >= 'q16'")
    ranker = train_ranker(
        train, ["signal", "noise"], 40, 0.5, num_leaves=12, validation=held, eval_at=(5,), patience=2
    )
    last, scores = ranker.history[-1][0], [ndcg for _, _, ndcg in ranker.history]
    assert last < 40 and max(scores[:-2]) >= max(scores[-2:])
    assert ranker.model.getNumTrees == scores.index(max(scores)) + 1


def test_models_leaves_are_exact(judged):
    ranker = train_ranker(judged, ["signal", "noise"], 2, num_leaves=7)
    assert [tree.numNodes for tree in ranker.model.trees] == [13, 13]


def test_rows_of_many_tasks_give_the_same_model(judged, monkeypatch):
    def scores():
        ranker = train_ranker(judged, ["signal", "noise"], 12, num_leaves=9, checkpoint_every=4)
        return [(*row[:2], round(row[2], 9)) for row in rows_of(ranker.predict(judged).select("query_id", "doc_id", "model_score"), "query_id", "doc_id")]

    whole = scores()
    monkeypatch.setattr("quillrank.operators.ranker.ROWS_PER_PARTITION", 30)
    assert judged.count() > 120 and scores() == whole


def test_ndcg_by_rank_equals_one_rank_at_a_time(judged):
    for k, ndcg in sorted(tuple(row) for row in ndcg_by_rank(judged, "signal", (1, 3, 5, 10)).collect()):
        assert ndcg == evaluate(judged, "signal", k).first()["ndcg"]
