"""Trees of a saved model as a table, and feature weights computed from it.

The table is read from the files that ``model.dump`` saves, by Spark, so a dump of any
number of trees is never written out on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tree_nodes(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """One row per node of a saved tree ensemble; ``names`` are the features in their order.

    ``(tree, node, feature, threshold, gain, cover, n_rows, prediction, left, right, tree_weight)``: ``feature``,
    ``threshold``, ``gain`` and the children are null in leaves; ``cover`` is the weight of the training rows at the
    node, ``n_rows`` their number. Rows with a value up to the threshold go left.
    """
    data = spark.read.parquet(f"{path.rstrip('/')}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path.rstrip('/')}/treesMetadata").toDF("_tree", "_meta", "tree_weight")
    inner = F.col("leftChild") >= 0
    of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex") + 1)
    nodes = data.select(
        F.col("treeID").cast("long").alias("tree"), F.col("id").cast("long").alias("node"), F.when(inner, of).alias("feature"),
        F.when(inner & (F.col("split.numCategories") < 0), F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"), F.col("impurityStats")[0].alias("cover"), F.col("rawCount").alias("n_rows"),
        "prediction", F.when(inner, F.col("leftChild")).cast("long").alias("left"),
        F.when(inner, F.col("rightChild")).cast("long").alias("right"))
    return nodes.join(weights.select(F.col("_tree").cast("long").alias("tree"), "tree_weight"), "tree")


def feature_weights(nodes: DataFrame) -> DataFrame:
    """``(feature, weight, gain, cover, importance)`` of the features that split.

    ``weight`` counts the splits, ``gain`` and ``cover`` are their means, and ``importance`` is the feature's share of
    the sum of gain times cover over all trees, as in the model's own importances.
    """
    splits = nodes.where("feature is not null")
    part = F.sum(F.col("gain") * F.col("cover"))
    found = splits.groupBy("feature").agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"),
                                          part.alias("_part"))
    # at most one row for each feature
    return found.selectExpr("feature", "weight", "gain", "cover", "coalesce(_part / nullif(sum(_part) over (), 0), 0) as importance")
