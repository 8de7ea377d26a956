"""A pairwise gradient-boosted ranker (LambdaMART) whose trees are grown best first, as a Spark ML model.

Each round ranks every query by the current score, derives a gradient and a curvature per row from
the pairs whose exchange would change NDCG, and grows one tree on their sums (:mod:`quillrank.operators.trees`):
its leaves are Newton steps and its split gains Newton gains.

NDCG is cut at ``truncation`` ranks, so only pairs with a row among the first ``truncation`` count:
every row meets a list of at most that many rows, never its whole query.

As long as no query is cut into blocks, every task holds whole queries and finds the gradients of its rows by itself;
nothing is shuffled after the first round, and rows that make one task only are boosted there.
Otherwise the first rows of each query are shuffled to its blocks.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.operators.grouping import HOT_ROWS, skew_join, top_k_per_group
from quillrank.operators.metrics import discount, gain, ideal_dcg, ndcg_by_rank
from quillrank.operators.trees import (
    MAX_BINS,
    NODES,
    STEPS,
    Node,
    Rows,
    Tree,
    add_scores,
    bin_edges,
    bin_matrix,
    grow,
    grow_here,
    raised_scores,
    spark_tree,
    tree_rows,
    trees_of,
    with_bins,
)
from quillrank.schemas import ALL_FEATURES, require_columns
from quillrank.session import checkpointed, let_workers_import, materialise, new_work_path, remove_paths, work_folder

TRUNCATION = 30
# Training rows per partition; every round runs several small jobs over all of them.
ROWS_PER_PARTITION = 20_000
# Rows whose pairs are held at once, and rows of a batch that goes back to Spark.
PAIRED_ROWS, BATCH_ROWS = 20_000, 10_000
_VECTOR, _VALUES = "_features", "_values"
# The ranks at which NDCG of the validation rows is measured after each round.
EVAL_AT = (1, 3, 5)


@dataclass(frozen=True)
class Ranker:
    """A trained ensemble with the names of the features it reads.

    ``history`` has ``(round, k, ndcg)`` of the validation rows after each round, if there were any.
    """

    features: list[str]
    model: GBTRegressionModel
    history: tuple[tuple[int, int, float], ...] = ()

    def history_table(self) -> DataFrame:
        return SparkSession.active().createDataFrame(list(self.history), "round INT, k INT, ndcg DOUBLE")

    def predict(self, featured: DataFrame, score: str = "model_score") -> DataFrame:
        """Add the model's score per row; no shuffle."""
        require_columns(featured, self.features, "features")
        scored = self.model.transform(assemble(featured, self.features))
        return scored.withColumnRenamed("prediction", score).drop(_VECTOR)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/model")
        names = spark.createDataFrame(list(enumerate(self.features)), "position INT, feature STRING")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


@dataclass(frozen=True)
class LinearScorer:
    """A fixed weighted sum of features, in place of a :class:`Ranker`; absent values count as 0."""

    weights: dict[str, float]

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def predict(self, featured: DataFrame, score: str = "model_score") -> DataFrame:
        """Add the sum at six decimals."""
        require_columns(featured, self.features, "features")
        total = F.lit(0.0)
        for name, weight in self.weights.items():
            total = total + weight * _number(name)
        return featured.withColumn(score, F.round(total, 6))


def load_ranker(spark: SparkSession, path: str) -> Ranker:
    """Raises ``FileNotFoundError`` if nothing was saved there."""
    from quillrank.sources.tables import read_parquet

    try:
        names = read_parquet(spark, f"{path}/features").orderBy("position").collect()
    except FileNotFoundError:
        raise FileNotFoundError(f"Model not found at {path}. Run training first.") from None
    return Ranker([row["feature"] for row in names], GBTRegressionModel.load(f"{path}/model"))


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector; absent values count as 0."""
    filled = df.withColumns({f"_f_{name}": _number(name) for name in features})
    inputs = [f"_f_{name}" for name in features]
    return VectorAssembler(inputCols=inputs, outputCol=_VECTOR).transform(filled).drop(*inputs)


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def train_ranker(
    featured: DataFrame,
    features: Sequence[str] | None = None,
    n_estimators: int = 200,
    learning_rate: float = 0.05,
    num_leaves: int = 31,
    min_data_in_leaf: int = 1,
    min_data_in_bin: int = 1,
    max_bins: int = MAX_BINS,
    truncation: int = TRUNCATION,
    query_key: str = "query_id",
    tie: str = "doc_id",
    checkpoint_every: int = 10,
    hot_rows: int = HOT_ROWS,
    validation: DataFrame | None = None,
    eval_at: Sequence[int] = EVAL_AT,
    patience: int | None = None,
    constant: bool = False,
) -> Ranker:
    """Boost ``n_estimators`` trees of ``num_leaves`` leaves on ``featured`` rows.

    A tree has fewer leaves only if no further split gains anything; training ends with a tree that cannot be
    split at all. ``validation`` rows are scored along, and NDCG at the ranks ``eval_at`` is kept for every round.
    With ``patience`` training stops once none of these has risen for so many rounds, and the trees after the
    last rise are left out.
    Raises ``ValueError`` for absent features, or if no query has rows of different relevance; with ``constant`` the
    latter gives a warning and a tree of one leaf, which leaves all rows in the order of the tie.
    """
    features = list(features or ALL_FEATURES)
    require_columns(featured, features, "features")
    require_columns(featured, [query_key, tie, "relevance"])
    work_folder(featured.sparkSession)
    let_workers_import(featured.sparkSession)

    data, largest = _training_rows(featured, features, truncation, query_key, tie, hot_rows)
    if largest == 0:
        why = "no query has two rows of different relevance to learn from"
        if not constant:
            raise ValueError(why)
        warnings.warn(f"{why}: the model is constant", stacklevel=2)
        return Ranker(features, _ensemble([Tree([Node(0.0, 0.0, 0)])], [[]] * len(features), learning_rate))
    edges = bin_edges(featured.select(*[_number(name).alias(name) for name in features]), features, max_bins, min_data_in_bin)
    widths = [len(own) + 1 for own in edges]
    options = (len(edges), learning_rate, checkpoint_every)
    if largest > hot_rows:
        rows = _Boosted(with_bins(data, _VALUES, edges), *options)
    else:
        rows = _Grouped(data, edges, *options)
    held_out = None
    if validation is not None:
        values = F.array(*[_number(name) for name in features]).alias(_VALUES)
        kept = with_bins(validation.select(query_key, tie, "relevance", values), _VALUES, edges)
        held_out = _Boosted(kept, *options)

    trees: list[Tree] = []
    history: list[tuple[int, int, float]] = []
    best, best_round = dict.fromkeys(eval_at, -1.0), 0
    fitted = _rounds(rows, n_estimators, widths, num_leaves, min_data_in_leaf, truncation)
    for number, tree in enumerate(fitted, 1):
        trees.append(tree)
        if held_out is not None:
            held_out.add(tree)
            measured = ndcg_by_rank(held_out.state, "score", eval_at, query_key=query_key, tie=tie).collect()
            history += sorted((number, row["k"], row["ndcg"]) for row in measured)
            for row in measured:
                if row["ndcg"] > best[row["k"]]:
                    best[row["k"]], best_round = row["ndcg"], number
            if patience and number - best_round >= patience:
                trees = trees[:best_round]
                break
    rows.release()
    if held_out is not None:
        held_out.release()
    return Ranker(features, _ensemble(trees, edges, learning_rate), tuple(history))


def _rounds(
    rows: _Boosted | _Grouped,
    n_estimators: int,
    widths: Sequence[int],
    num_leaves: int,
    min_data_in_leaf: int,
    truncation: int,
) -> Iterator[Tree]:
    """The tree of each round, until one cannot be split; rows that make one task are boosted there."""
    if isinstance(rows, _Grouped) and rows.most <= ROWS_PER_PARTITION:
        yield from rows.boosted(n_estimators, widths, num_leaves, min_data_in_leaf, truncation)
        return
    for number in range(n_estimators):
        steps = rows.steps(truncation).persist()
        tree = grow(steps, widths, num_leaves, min_data_in_leaf, rows.partitions, rows.most)
        steps.unpersist()
        if number and tree.leaves() == 1:
            return
        rows.add(tree)
        yield tree


class _Boosted:
    """Rows whose ``score`` grows tree by tree.

    Trees are added to the rows as last stored, in one pass over all of them; every ``checkpoint_every``
    rounds the scores are written to the shared folder.
    """

    def __init__(self, rows: DataFrame, features: int, weight: float, checkpoint_every: int) -> None:
        self.base = materialise(rows.withColumn("score", F.lit(0.0)), "boosted")
        self.features, self.weight, self.checkpoint_every = features, weight, checkpoint_every
        self.pending: list[Tree] = []
        self.state = self.base.persist()
        self.partitions = self.most = None  # not known

    def steps(self, truncation: int) -> DataFrame:
        return _newton_steps(self.state, truncation, True, "bins")

    def add(self, tree: Tree) -> None:
        self.pending.append(tree)
        raised = add_scores(self.base, self.pending, self.weight, self.features)
        if len(self.pending) == self.checkpoint_every:
            raised = self.base = materialise(raised, "boosted")
            self.pending = []
        before, self.state = self.state, raised.persist()
        before.unpersist()

    def release(self) -> None:
        self.state.unpersist()


class _Grouped:
    """Rows of whole queries, each in one task and sorted by the tie, whose ``score`` grows tree by tree.

    A pass over the rows adds the trees since they were last stored; every ``checkpoint_every`` rounds the scores
    are written to the shared folder, in the same tasks and order.
    """

    def __init__(
        self, data: DataFrame, edges: Sequence[Sequence[float]], features: int, weight: float, checkpoint_every: int
    ) -> None:
        self.features, self.weight, self.checkpoint_every = features, weight, checkpoint_every
        place = F.row_number().over(Window.partitionBy("query", "block").orderBy("row"))
        rows = data.select((place == 1).alias("first"), "gain", "inverse_ideal", _VALUES)
        rows = with_bins(rows, _VALUES, edges).withColumn("score", F.lit(0.0))
        self.base, self.path = checkpointed(rows)
        self.base.persist()
        self.most, self.partitions = self.base.count(), self.base.rdd.getNumPartitions()
        self.pending: list[Tree] = []

    def boosted(
        self, rounds: int, widths: Sequence[int], num_leaves: int, min_data_in_leaf: int, truncation: int
    ) -> list[Tree]:
        """All rounds in one task, for no more rows than a task has anyway; only the trees come to the driver."""
        weight, features = self.weight, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = list(_whole_queries(batches))
            if not parts:
                return
            rows = pa.concat_tables(parts)
            first, gain, scale, score = (_numbers(rows, name) for name in ("first", "gain", "inverse_ideal", "score"))
            bins = bin_matrix(rows["bins"].combine_chunks(), features)
            trees: list[Tree] = []
            for number in range(rounds):
                gradient, curvature = pulls(first, gain, scale, score, truncation)
                pulled = Rows(bins, gradient, curvature).where(curvature > 0)
                tree = grow_here(pulled, widths, num_leaves, min_data_in_leaf)
                if number and tree.leaves() == 1:
                    break
                trees.append(tree)
                score = raised_scores(score, bins, [tree], weight)
            yield tree_rows(trees)

        return trees_of(self.base.coalesce(1).mapInArrow(run, NODES).toArrow())

    def steps(self, truncation: int) -> DataFrame:
        """``(bins, gradient, curvature)`` of the rows some pair pulls on; no shuffle."""
        trees, weight, features = list(self.pending), self.weight, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _whole_queries(batches):
                first, gain, scale, score = (_numbers(rows, name) for name in ("first", "gain", "inverse_ideal", "score"))
                bins = rows["bins"].combine_chunks()
                score = raised_scores(score, bin_matrix(bins, features), trees, weight)
                gradient, curvature = pulls(first, gain, scale, score, truncation)
                kept = curvature > 0
                columns = [bins.filter(pa.array(kept)), pa.array(gradient[kept]), pa.array(curvature[kept])]
                out = pa.RecordBatch.from_arrays(columns, STEPS.names)
                for start in range(0, out.num_rows, BATCH_ROWS):
                    yield out.slice(start, BATCH_ROWS)

        return self.base.mapInArrow(run, STEPS)

    def add(self, tree: Tree) -> None:
        self.pending.append(tree)
        if len(self.pending) < self.checkpoint_every:
            return
        before, path = self.base, self.path
        self.base, self.path = checkpointed(add_scores(before, self.pending, self.weight, self.features))
        self.base.persist()
        self.pending = []
        before.unpersist()
        remove_paths(before.sparkSession, [path])

    def release(self) -> None:
        self.base.unpersist()
        remove_paths(self.base.sparkSession, [self.path])


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    return rows[name].combine_chunks().to_numpy(zero_copy_only=False)


def _whole_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of the batches again, cut only where ``first`` begins a query."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch.column("first").to_numpy(zero_copy_only=False))
        if not len(starts):
            held.append(batch)
            continue
        last = int(starts[-1])
        held.append(batch.slice(0, last))
        if any(part.num_rows for part in held):
            yield pa.Table.from_batches(held)
        held = [batch.slice(last)]
    if any(part.num_rows for part in held):
        yield pa.Table.from_batches(held)


def pulls(
    first: np.ndarray, gain: np.ndarray, scale: np.ndarray, score: np.ndarray, truncation: int
) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of each row, as :func:`_newton_steps` has them, of whole queries sorted by the tie."""
    n = len(score)
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(len(starts)), lengths)
    rounded = np.copysign(np.floor(np.abs(score) * 1e6 + 0.5), score)
    order = np.lexsort((-rounded, group))  # equal ones stay in the order of the tie
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - starts[group]
    weight = np.where(rank < truncation, 1 / np.log2(rank + 2), 0.0)
    met = np.minimum(lengths, truncation)[group]
    gradient, curvature = np.zeros(n), np.zeros(n)
    for start in range(0, n, PAIRED_ROWS):
        partners = met[start : start + PAIRED_ROWS]
        row = np.repeat(np.arange(start, start + len(partners)), partners)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(partners) - partners, partners)
        top = order[starts[group[row]] + nth]
        higher, lower = gain[row] > gain[top], gain[row] < gain[top]
        differ = higher | lower  # neither for an absent relevance
        row, top, sign = row[differ], top[differ], np.where(higher[differ], 1.0, -1.0)
        change = np.abs(gain[row] - gain[top]) * np.abs(weight[row] - weight[top]) * scale[row]
        with np.errstate(over="ignore"):
            doubt = 1 / (1 + np.exp(sign * (score[row] - score[top])))
        pull, curve = sign * doubt * change, doubt * (1 - doubt) * change
        gradient[start : start + len(partners)] += np.bincount(row - start, pull, len(partners))
        curvature[start : start + len(partners)] += np.bincount(row - start, curve, len(partners))
        # Rows below the cut pull their top partners the opposite way.
        below = rank[row] >= truncation
        if below.any():
            np.subtract.at(gradient, top[below], pull[below])
            np.add.at(curvature, top[below], curve[below])
    return gradient, curvature


def _training_rows(
    featured: DataFrame, features: list[str], truncation: int, query_key: str, tie: str, hot_rows: int
) -> tuple[DataFrame, int]:
    """Rows of queries with something to order, partitioned once by query and block.

    A query above ``hot_rows`` is cut into blocks by document.
    """
    grades = featured.groupBy(query_key, "relevance").agg(F.count("*").alias("n"))
    levels = F.sort_array(F.collect_list(F.struct("relevance", "n")), asc=False)
    queries = materialise(
        grades.groupBy(query_key)
        .agg(levels.alias("levels"), F.sum("n").alias("rows"))
        .where(F.size("levels") > 1)
        .select(
            query_key,
            "rows",
            (1 / ideal_dcg(F.col("levels"), truncation)).alias("inverse_ideal"),
            F.ceil(F.col("rows") / hot_rows).cast("int").alias("blocks"),
        ),
        "ranker-queries",
    )
    values = F.array(*[_number(name) for name in features]).alias(_VALUES)
    rows = featured.select(query_key, tie, gain(F.col("relevance")).alias("gain"), values)
    rows = skew_join(rows, queries, [query_key], [tie], F.col("rows"), hot_rows=hot_rows)
    blocked = rows.select(
        F.col(query_key).alias("query"),
        F.pmod(F.xxhash64(tie), F.col("blocks")).cast("int").alias("block"),
        F.col(tie).alias("row"),
        "blocks",
        "gain",
        "inverse_ideal",
        _VALUES,
    )
    sizes = queries.agg(
        F.coalesce(F.max("rows"), F.lit(0)).alias("largest"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total")
    ).first()
    partitions = max(1, -(-sizes["total"] // ROWS_PER_PARTITION))
    return blocked.repartition(partitions, "query", "block"), sizes["largest"]


def gradients(
    featured: DataFrame,
    score: str,
    truncation: int = TRUNCATION,
    query_key: str = "query_id",
    tie: str = "doc_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(query_key, tie, gradient, curvature, target)``: where the next round would move the rows from ``score``.

    Only rows that some pair pulls on are given.
    """
    data, largest = _training_rows(featured, [score], truncation, query_key, tie, hot_rows)
    state = data.withColumn("score", F.get(_VALUES, F.lit(0)))
    steps = _newton_steps(state, truncation, largest > truncation)
    return steps.select(F.col("query").alias(query_key), F.col("row").alias(tie), "gradient", "curvature", "target")


def _pair(row_gain: Column, row_score: Column, row_discount: Column, top: Column, scale: Column) -> Column:
    """Gradient and curvature one row gets from its pair with a top row."""
    sign = F.when(row_gain > top["gain"], 1.0).otherwise(-1.0)
    change = F.abs(row_gain - top["gain"]) * F.abs(row_discount - discount(top["rank"])) * scale
    doubt = 1 / (1 + F.exp(sign * (row_score - top["score"])))
    return F.struct(
        (sign * doubt * change).alias("gradient"), (doubt * (1 - doubt) * change).alias("curvature")
    )


def _newton_steps(state: DataFrame, truncation: int, beyond: bool, carried: str = _VALUES) -> DataFrame:
    """``(query, row, carried, gradient, curvature, target)`` of the rows some pair pulls on."""
    order = [F.round(F.col("score"), 6).desc(), F.col("row")]
    ranked = top_k_per_group(
        state.select("query", "block", "blocks", "row", "score", "gain"), ["query"], order, truncation
    )
    # At most `truncation` rows per query, copied to each of its blocks.
    tops = (
        ranked.groupBy("query", "blocks")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "block", "row", "score", "gain"))).alias("tops"))
        .select("query", "tops", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    )
    met = state.join(tops, ["query", "block"])
    own = F.filter("tops", lambda top: top["row"] == F.col("row"))
    met = met.withColumn("rank", F.get(own, F.lit(0))["rank"]).withColumn(
        "discount", F.coalesce(discount(F.col("rank")), F.lit(0.0))
    )

    zero = F.struct(F.lit(0.0).alias("gradient"), F.lit(0.0).alias("curvature"))

    def add(total: Column, top: Column) -> Column:
        pair = _pair(F.col("gain"), F.col("score"), F.col("discount"), top, F.col("inverse_ideal"))
        return F.when(
            top["gain"] != F.col("gain"),
            F.struct(
                (total["gradient"] + pair["gradient"]).alias("gradient"),
                (total["curvature"] + pair["curvature"]).alias("curvature"),
            ),
        ).otherwise(total)

    pulled = met.withColumn("pull", F.aggregate("tops", zero, add))
    gradient, curvature = F.col("pull.gradient"), F.col("pull.curvature")
    if beyond:
        # Rows below the cut pull their top partners the opposite way; summed per partner before
        # the shuffle.
        below = met.where(F.col("rank").isNull()).withColumn("top", F.explode("tops"))
        below = below.where(F.col("top.gain") != F.col("gain")).withColumn(
            "pull",
            _pair(F.col("gain"), F.col("score"), F.col("discount"), F.col("top"), F.col("inverse_ideal")),
        )
        returned = below.groupBy("query", F.col("top.block").alias("block"), F.col("top.row").alias("row")).agg(
            F.sum("pull.gradient").alias("back_gradient"), F.sum("pull.curvature").alias("back_curvature")
        )
        pulled = pulled.join(returned, ["query", "block", "row"], "left")
        gradient = gradient - F.coalesce("back_gradient", F.lit(0.0))
        curvature = curvature + F.coalesce("back_curvature", F.lit(0.0))
    return (
        pulled.select("query", "row", carried, gradient.alias("gradient"), curvature.alias("curvature"))
        .where(F.col("curvature") > 0)
        .withColumn("target", F.col("gradient") / F.col("curvature"))
    )


def _ensemble(trees: Sequence[Tree], edges: Sequence[Sequence[float]], weight: float) -> GBTRegressionModel:
    """The trees as one Spark ML model, through its public JVM constructor."""
    context = SparkSession.active().sparkContext
    jvm, gateway = context._jvm, context._gateway
    ml = jvm.org.apache.spark.ml.regression
    members = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for position, tree in enumerate(trees):
        members[position] = spark_tree(tree, edges, f"quillrank_tree_{position}")
        weights[position] = float(weight)
    uid = f"quillrank_{uuid.uuid4().hex[:12]}"
    return GBTRegressionModel(ml.GBTRegressionModel(uid, members, weights)).setFeaturesCol(_VECTOR)


def feature_importance(ranker: Ranker) -> DataFrame:
    """``(feature, gain_importance, split_importance)`` by gain: total gain and number of splits."""
    spark = SparkSession.active()
    path = new_work_path(spark, "ranker-nodes")
    ranker.model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*")
    splits = nodes.where(F.col("split.featureIndex") >= 0).groupBy(
        F.col("split.featureIndex").alias("position")
    ).agg(
        # Stored gains are per unit of weight; the first statistic is the node's weight.
        F.sum(F.col("gain") * F.col("impurityStats")[0]).alias("gain"),
        F.count("*").alias("splits"),
    )
    names = spark.createDataFrame(list(enumerate(ranker.features)), "position INT, feature STRING")
    return (
        names.join(splits, "position", "left")
        .select(
            "feature",
            F.coalesce("gain", F.lit(0.0)).alias("gain_importance"),
            F.coalesce("splits", F.lit(0)).alias("split_importance"),
        )
        .orderBy(F.col("gain_importance").desc(), "feature")
    )
