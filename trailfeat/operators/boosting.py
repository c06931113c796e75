"""Boosted trees round by round: sampled rows and columns, and metrics of every round.

``fit_rounds`` boosts regression trees on the gradients of the log loss, as
``model.fit`` does, but deals the rows and columns of each round by hash, so that a
sampled model is the same whatever the partitioning. With all rows and columns it
gives the margins of Spark's own trainer. The margins of all rows are written to the
shared folder after each round, which keeps plans short and survives lost executors.

``round_metrics`` gives log loss and AUC after every round on any table, for instance
on the part that ``held_out`` sets aside, and ``best_round`` where to stop.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .evaluate import POS_WEIGHT, auc_of_counts, class_weights, score_counts
from .features import ml_feature_names, ml_table
from .model import MAX_BINS, MAX_DEPTH, MIN_INFO_GAIN, MIN_INSTANCES, ROUNDS, STEP_SIZE
from .sampling import SEED, in_sample, sampled_columns


def held_out(features: DataFrame, share: float, key: str = "traj_id", seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The rows to train on, and the ``share`` of rows to validate on, parted by a hash of the id."""
    out = in_sample(F.col(key), share, -1, seed)
    return features.where(~out), features.where(out)


@dataclass
class Boosted:
    """Trees with their weights and the positions of the columns that each saw."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    columns: list[list[int]] = field(default_factory=list)


def _tree_column(df: DataFrame, tree, columns: list[int], width: int, name: str) -> DataFrame:
    """``df`` (with ``features``) and the prediction of one tree."""
    if len(columns) < width:
        df = VectorSlicer(inputCol="features", outputCol="_some", indices=columns).transform(df)
    own = tree.copy()
    own.setFeaturesCol("_some" if len(columns) < width else "features").setPredictionCol(name)
    return own.transform(df).drop("_some")


def _residual(margin: Column, label: Column) -> Column:
    """The negative gradient of the log loss at a margin; label 0 or 1."""
    y = 2.0 * label - 1.0
    return 4.0 * y / (1.0 + F.exp(2.0 * y * margin))


def fit_rounds(features: DataFrame, rounds: int = ROUNDS, step_size: float = STEP_SIZE, max_depth: int = MAX_DEPTH,
               row_share: float = 1.0, column_share: float = 1.0, pos_weight: float = POS_WEIGHT, seed: int = SEED) -> Boosted:
    """Boost on a labelled feature matrix; every round sees ``row_share`` of the rows and ``column_share`` of the columns."""
    spark, names = features.sparkSession, ml_feature_names(features.columns)
    table = class_weights(ml_table(features), pos_weight=pos_weight).select("traj_id", "features", "label", "weight")
    state, model = table.withColumn("margin", F.lit(0.0)), Boosted()
    for k in range(rounds):
        # the first tree fits the classes themselves, with weight 1
        target = 2.0 * F.col("label") - 1.0 if k == 0 else _residual(F.col("margin"), F.col("label"))
        rows = state.withColumn("target", target)
        rows = rows.where(in_sample(F.col("traj_id"), row_share, k, seed)) if row_share < 1 else rows
        columns = sampled_columns(names, column_share, k, seed)
        if len(columns) < len(names):
            rows = VectorSlicer(inputCol="features", outputCol="_some", indices=columns).transform(rows)
        tree = DecisionTreeRegressor(featuresCol="_some" if len(columns) < len(names) else "features", labelCol="target",
                                     weightCol="weight", maxDepth=max_depth, maxBins=MAX_BINS, minInstancesPerNode=MIN_INSTANCES,
                                     minInfoGain=MIN_INFO_GAIN, seed=seed).fit(rows)
        weight = 1.0 if k == 0 else step_size
        model.trees.append(tree)
        model.weights.append(weight)
        model.columns.append(columns)
        if k < rounds - 1:
            path = scratch_path(spark, "margins")
            _tree_column(state, tree, columns, len(names), "_tree").withColumn(
                "margin", F.col("margin") + F.lit(weight) * F.col("_tree")).drop("_tree").write.parquet(path)
            state = spark.read.parquet(path)
    return model


def as_boosted(model) -> Boosted:
    """A fitted ``GBTClassificationModel`` in the same form."""
    every = list(range(model.numFeatures))
    return Boosted(list(model.trees), [float(w) for w in model.treeWeights], [every for _ in model.trees])


def staged_margins(model: Boosted, features: DataFrame, keep=()) -> DataFrame:
    """``(traj_id, *keep, margins)``: the margin of every row after each round."""
    names = ml_feature_names(features.columns)
    held = [F.col(c).alias(f"_keep_{c}") for c in keep]
    df = ml_table(features, keep=held)
    for k, (tree, columns) in enumerate(zip(model.trees, model.columns, strict=True)):
        df = _tree_column(df, tree, columns, len(names), f"_tree{k}")
    steps = F.array(*[F.lit(w) * F.col(f"_tree{k}") for k, w in enumerate(model.weights)])
    run = F.aggregate(steps, F.array().cast("array<double>"), lambda acc, s: F.concat(
        acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + s)))
    return df.select("traj_id", *[F.col(f"_keep_{c}").alias(c) for c in keep], run.alias("margins"))


def score_of(margin: Column) -> Column:
    """The probability of label 1 at a margin."""
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


def round_metrics(model: Boosted, features: DataFrame) -> DataFrame:
    """``(round, n, logloss, auc)`` of every round (1 is the first) on a labelled feature matrix."""
    staged = staged_margins(model, features, keep=("label",))
    rows = staged.select(F.col("label").cast("double").alias("label"), F.posexplode("margins").alias("at", "margin"))
    rows = rows.withColumn("round", (F.col("at") + 1).cast("long"))
    x = -2.0 * (2.0 * F.col("label") - 1.0) * F.col("margin")
    loss = F.when(x > 30, x).otherwise(F.log1p(F.exp(x)))
    losses = rows.groupBy("round").agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("logloss"))
    return losses.join(auc_of_counts(score_counts(rows, "margin", "label", by=["round"]), by=["round"]), "round")


def best_round(metrics: DataFrame, patience: int | None = None) -> int:
    """The round of the least log loss; with ``patience``, of those before the loss has not improved for so many rounds."""
    rows = metrics.orderBy("round").collect()  # one row for each round
    best = None
    for r in rows:
        if best is None or r["logloss"] < best["logloss"]:
            best = r
        elif patience is not None and r["round"] - best["round"] >= patience:
            break
    return best["round"] if best else 0


def first_rounds(model: Boosted, rounds: int) -> Boosted:
    """The model as it was after so many rounds."""
    return Boosted(model.trees[:rounds], model.weights[:rounds], model.columns[:rounds])


def predict(model: Boosted, features: DataFrame) -> DataFrame:
    """``traj_id, score (P[label = 1]), prediction``."""
    last = staged_margins(model, features).select("traj_id", F.element_at("margins", -1).alias("_m"))
    return last.select("traj_id", score_of(F.col("_m")).alias("score"), (F.col("_m") > 0).cast("double").alias("prediction"))
