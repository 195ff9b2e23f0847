"""A fitted ensemble of trees as a table of nodes, as SQL text, and its importances."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir


def tree_table(spark: SparkSession, classifier: GBTClassificationModel) -> DataFrame:
    """One row a node: tree, weight, node, left and right child (null for leaves), feature, threshold,
    prediction, gain and the training rows that reached it.

    Rows whose value of ``feature`` is at most ``threshold`` go left. Read from the model's own storage
    format, so the driver holds no more than the model itself.
    """
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/tidemark/{app}/trees-{uuid.uuid4().hex}"
    classifier.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights")
    split = F.col("leftChild") >= 0
    return nodes.join(F.broadcast(weights.drop("metadata")), "treeID").select(
        F.col("treeID").alias("tree"),
        F.col("weights").alias("weight"),
        F.col("id").alias("node"),
        F.when(split, F.col("leftChild")).alias("left"),
        F.when(split, F.col("rightChild")).alias("right"),
        F.when(split, F.col("split.featureIndex")).alias("feature"),
        F.when(split, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        "prediction",
        F.when(split, F.col("gain")).alias("gain"),
        F.col("impurityStats")[0].alias("rows"),
    )


def importances(trees: DataFrame) -> DataFrame:
    """(feature, importance): the share of the gain, weighted by rows, that a feature's splits bring.

    Shares are taken within each tree, summed over trees, and brought to a sum of one.
    """
    gains = (
        trees.filter(F.col("feature").isNotNull())
        .groupBy("tree", "feature")
        .agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    )
    totals = gains.groupBy("tree").agg(F.sum("gain").alias("whole")).filter("whole > 0")
    shares = gains.join(totals, "tree").withColumn("share", F.col("gain") / F.col("whole"))
    sums = shares.groupBy("feature").agg(F.sum("share").alias("share"))
    whole = sums.agg(F.sum("share").alias("whole"))
    return sums.join(F.broadcast(whole)).select(
        "feature", (F.col("share") / F.col("whole")).alias("importance")
    )


def number_text(value: float) -> str:
    """A double that SQL engines read back as the same double."""
    return f"{value:.17e}"


def tree_texts(trees: DataFrame, features: Sequence[str]) -> list[tuple[float, str]]:
    """Weight and CASE expression of each tree over the named features, in order of the trees."""
    nodes = {(row["tree"], row["node"]): row for row in trees.collect()}

    def text(tree: int, node: int) -> str:
        row = nodes[tree, node]
        if row["feature"] is None:
            return number_text(row["prediction"])
        left, right = text(tree, row["left"]), text(tree, row["right"])
        condition = f"{features[row['feature']]} <= {number_text(row['threshold'])}"
        return f"case when {condition} then {left} else {right} end"

    roots = sorted(tree for tree, node in nodes if node == 0)
    return [(nodes[tree, 0]["weight"], text(tree, 0)) for tree in roots]


def probability_sql(
    trees: DataFrame, features: Sequence[str], medians: dict[str, float], source: str, key: str
) -> str:
    """A query over ``source`` giving ``key`` and churn_probability, for any engine with CASE and EXP.

    A missing feature counts as its median. The trees stand in columns of one derived table, so that no
    expression grows with their number.
    """
    texts = tree_texts(trees, features)
    filled = ", ".join(
        f"coalesce(cast({name} as double), {number_text(medians[name])}) {name}" for name in features
    )
    columns = ", ".join(f"{text} t{k}" for k, (_, text) in enumerate(texts))
    margin = " + ".join(f"{number_text(weight)} * t{k}" for k, (weight, _) in enumerate(texts))
    return (
        f"select {key}, {number_text(1.0)} / ({number_text(1.0)} + exp(-{number_text(2.0)} * ({margin})))"
        f" churn_probability from (select {key}, {columns} from (select {key}, {filled} from {source}))"
    )
