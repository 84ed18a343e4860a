"""Tree models as a table of nodes, and rows that walk it by joins.

A node table has one row per node of every tree: ``tree``, ``node``, ``feature`` (position in the
feature array, -1 for a leaf), ``threshold`` (left is up to it) or ``categories`` (left are those in it),
``lft``, ``rgt``, ``value`` (the share of the positive class, or the tree's own value for boosted
trees) and ``weight`` of the tree. It can be stored, compared, filtered and applied without the model.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.session import shared_path

NODE_BYTES = 128  # of a node in a join's table, with some room
SENT_BYTES = 256 << 20  # node tables up to this size go to all tasks


def node_table(model: RandomForestClassificationModel | GBTClassificationModel) -> DataFrame:
    """The nodes of a fitted two-class model, read from its saved form."""
    if model.numClasses != 2:
        raise ValueError("a model of two classes is needed")
    spark = SparkSession.active()
    path = shared_path(spark, "trees")
    model.write().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    boosted = isinstance(model, GBTClassificationModel)
    stats = F.col("impurityStats")
    value = F.col("prediction") if boosted else stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    cut = F.col("split.leftCategoriesOrThreshold")
    continuous = F.col("split.numCategories") == -1
    return rows.join(trees, "tree").select(
        "tree", F.col("id").alias("node"), F.when(F.col("leftChild") < 0, -1).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.when(continuous & (F.size(cut) > 0), F.get(cut, F.lit(0))).alias("threshold"), F.when(~continuous, cut).alias("categories"),
        F.col("leftChild").alias("lft"), F.col("rightChild").alias("rgt"), value.alias("value"), "weight",
    )


def leaves(rows: DataFrame, nodes: DataFrame, depth: int, key: str = "row_id", features: str = "x") -> DataFrame:
    """key, tree, node, value and weight: the leaf of every tree that a row ends in, after at most ``depth`` steps.

    ``features`` is an array of numbers; a null or missing entry goes right. Node tables of a model have a
    size that does not follow the rows: a small one goes to all tasks, so that a row and its trees stay
    in one place through all steps; a larger one is joined as Spark sees fit.
    """
    size = nodes.agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("categories"), F.lit(0)).cast("long")).alias("listed")).first()
    small = size.n * NODE_BYTES + max(0, size.listed or 0) * 8 <= SENT_BYTES
    roots = nodes.where("node = 0").agg(F.sort_array(F.collect_set("tree")).alias("_trees"))  # a number per tree
    trees = roots.first()._trees
    at = rows.select(F.col(key).alias("_key"), F.col(features).alias("_x"), F.explode(F.array(*map(F.lit, trees))).alias("tree"))
    at = at.withColumn("node", F.lit(0))
    steps = nodes.where("lft >= 0").select("tree", "node", "feature", "threshold", "categories", "lft", "rgt")
    for _ in range(depth):
        met = at.join(F.broadcast(steps) if small else steps, ["tree", "node"], "left")
        value = F.get("_x", F.col("feature"))
        left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
        onward = F.when(F.col("lft").isNull(), F.col("node")).when(left, F.col("lft")).otherwise(F.col("rgt"))
        at = met.select("_key", "_x", "tree", onward.alias("node"))
    ends = nodes.select("tree", "node", "value", "weight")
    found = at.drop("_x").join(F.broadcast(ends) if small else ends, ["tree", "node"])
    return found.select(F.col("_key").alias(key), "tree", "node", "value", "weight")


def forest_scores(rows: DataFrame, nodes: DataFrame, depth: int, boosted: bool = False, key: str = "row_id", features: str = "x") -> DataFrame:
    """key (unique in ``rows``) and p: the mean share of the trees, or the logistic value of the sum of boosted trees."""
    by_row = leaves(rows, nodes, depth, key, features).groupBy(key)
    if boosted:
        total = by_row.agg(F.sum(F.col("value") * F.col("weight")).alias("_total"))
        return total.select(key, (1 / (1 + F.exp(-2 * F.col("_total")))).alias("p"))
    return by_row.agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("p"))


def split_counts(nodes: DataFrame) -> DataFrame:
    """feature, n_trees that split on it and n_splits."""
    return nodes.where("lft >= 0").groupBy("feature").agg(F.countDistinct("tree").alias("n_trees"), F.count("*").alias("n_splits"))
