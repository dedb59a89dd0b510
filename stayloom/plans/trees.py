"""Stored models as tables, and scores computed from those tables by SQL expressions alone.

A stored ensemble becomes a node table and a leaf table; a leaf carries its whole path as one interval of values per
feature. Both are bounded by the declared sizes of a model (trees × nodes), not by the data. Rescoring walks the nodes
inside one expression per row, so scoring any number of rows is a scan without join or shuffle. A logistic model is
certified by its gradient, which at the optimum is zero in every coordinate: one aggregate over the training rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = ("tree int, node int, feature int, threshold double, categories array<double>, left_node int, right_node int, "
         "value double, weight double")


def node_table(spark: SparkSession, model: str, boosted: bool) -> DataFrame:
    """Nodes of an ensemble stored at ``model``: ``tree, node, feature, threshold, categories, left_node, right_node,
    value, weight``.

    ``feature`` is -1 at a leaf. A split on a number has a threshold (up to it: left), one on categories the set that
    goes left. The value is the share of the positive class in the node, for boosted trees the node's prediction.
    """
    stored = spark.read.parquet(f"{model}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{model}/treesMetadata").select(
        F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    stats = F.col("impurityStats")
    share = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    ordered = F.col("split.numCategories") == -1
    return stored.join(weights, "treeID").select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.when(ordered & (F.col("leftChild") >= 0), F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(~ordered, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.col("leftChild").alias("left_node"), F.col("rightChild").alias("right_node"),
        (F.col("prediction") if boosted else share).alias("value"), "weight")


def leaf_table(nodes: DataFrame, depth: int) -> DataFrame:
    """``tree, node, value, path``: a leaf and the values that lead to it, as a list of ``feature, above, upto`` with one
    interval (above, upto] per feature; a NULL bound is open.

    ``depth`` rounds of a join from parents to children. Splits on categories are those of 0/1 features (one-hot
    slots): left is either 0, the interval up to 0, or 1, the interval above 0.
    """
    cut = F.coalesce("threshold", F.lit(0.0))
    zero_left = F.col("categories").isNull() | F.array_contains("categories", 0.0)
    children = nodes.filter("feature >= 0").select("tree", F.col("node").alias("parent"), F.inline(F.array(
        F.struct(F.col("left_node").alias("node"), F.col("feature"), F.when(~zero_left, cut).alias("above"),
                 F.when(zero_left, cut).alias("upto")),
        F.struct(F.col("right_node").alias("node"), F.col("feature"), F.when(zero_left, cut).alias("above"),
                 F.when(~zero_left, cut).alias("upto")))))
    step = F.struct("feature", "above", "upto")
    level = nodes.filter("node = 0").select("tree", "node", F.array().cast(
        "array<struct<feature:int,above:double,upto:double>>").alias("splits"))
    reached = level
    for _ in range(depth):
        level = children.join(level.select("tree", F.col("node").alias("parent"), "splits"), ["tree", "parent"]).select(
            "tree", "node", F.concat("splits", F.array(step)).alias("splits"))
        reached = reached.unionByName(level)

    def merged(splits: Column) -> Column:
        def one(f):
            mine = F.filter(splits, lambda s: s["feature"] == f)
            return F.struct(f.alias("feature"), F.array_max(F.transform(mine, lambda s: s["above"])).alias("above"),
                            F.array_min(F.transform(mine, lambda s: s["upto"])).alias("upto"))
        return F.transform(F.array_sort(F.array_distinct(F.transform(splits, lambda s: s["feature"]))), one)

    leaves = nodes.filter("feature < 0").select("tree", "node", "value", "weight")
    return leaves.join(reached, ["tree", "node"]).select(
        "tree", "node", "value", "weight", merged(F.col("splits")).alias("path"))


def packed_trees(nodes: DataFrame) -> Column:
    """All trees as one value, a scalar subquery: a list of ``weight, nodes``, nodes in the order of their numbers."""
    trees = nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(F.struct(
        "node", "feature", "threshold", "categories", "left_node", "right_node", "value"))).alias("nodes"))
    return trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees")).scalar()


def rescored(rows: DataFrame, nodes: DataFrame, depth: int, boosted: bool, vector: str = "features") -> DataFrame:
    """The rows with ``score``, the probability of the positive class as the stored trees give it.

    A forest averages the shares of the leaves; boosted trees add weighted values, and the logistic function of twice
    the sum is the probability.
    """
    def leaf(tree: Column, values: Column) -> Column:
        def next_node(node, _):
            at = F.get(values, node["feature"])
            goes_left = F.coalesce(at <= node["threshold"], F.array_contains(node["categories"], at))
            return F.when(node["feature"] < 0, node).otherwise(
                F.get(tree["nodes"], F.when(goes_left, node["left_node"]).otherwise(node["right_node"])))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.get(tree["nodes"], F.lit(0)), next_node,
                           lambda node: node["value"])

    total = F.aggregate("_trees", F.lit(0.0), lambda a, tree: a + tree["weight"] * leaf(tree, F.col("_x")))
    score = 1 / (1 + F.exp(-2 * total)) if boosted else total / F.aggregate(
        "_trees", F.lit(0.0), lambda a, tree: a + tree["weight"])
    return rows.withColumns({"_x": vector_to_array(vector), "_trees": packed_trees(nodes)}).withColumn(
        "score", score).drop("_x", "_trees")


def logistic_gradient(rows: DataFrame, model: LogisticRegressionModel, label: str, weight: str,
                      vector: str = "features") -> DataFrame:
    """``feature, gradient`` of the weighted, L2-penalised mean loss at the coefficients of the model; feature -1 is the
    intercept, which has no penalty. Zero in every row means that the optimum was found.

    One aggregate over the rows with partial sums per feature.
    """
    coefficients = F.lit([float(c) for c in model.coefficients.toArray()])
    strength = model.getRegParam()
    x = vector_to_array(vector)
    margin = F.aggregate(F.zip_with("_x", coefficients, lambda a, b: a * b), F.lit(float(model.intercept)),
                         lambda a, t: a + t)
    residual = rows.select(F.col(weight).cast("double").alias("_w"), F.col(label).cast("double").alias("_y"),
                           x.alias("_x")).withColumn("_r", F.col("_w") * (1 / (1 + F.exp(-margin)) - F.col("_y")))
    cells = residual.select("_w", "_r", F.posexplode(F.concat(F.array(F.lit(1.0)), "_x")).alias("at", "value"))
    slope = (F.sum(F.col("_r") * F.col("value")) / F.sum("_w")).alias("slope")
    return cells.groupBy("at").agg(slope).select(
        (F.col("at") - 1).alias("feature"),
        (F.col("slope") + F.when(F.col("at") > 0, strength * F.get(coefficients, F.col("at") - 1)).otherwise(0.0))
        .alias("gradient"))
