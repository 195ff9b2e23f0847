"""Training the churn classifier and scoring every customer with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.risk import risk_tier
from tidemark.operators.quantiles import exact_medians
from tidemark.operators.training import classification_report, fill_medians, stratified_split
from tidemark.plans import boosted_trees
from tidemark.session import stage, use_reliable_checkpoints

# The model's features in order.
FEATURES = (
    "total_orders",
    "lifetime_revenue",
    "avg_order_value",
    "total_items_purchased",
    "avg_delivery_days",
    "avg_delivery_delta_days",
    "avg_review_score",
    "worst_review_score",
    "avg_installments",
    "late_delivery_count",
    "customer_tenure_days",
    "recency_days",
    "frequency",
    "monetary",
    "rfm_combined_score",
    "unique_categories_purchased",
    "unique_products_purchased",
    "unique_payment_methods",
    "credit_card_usage_ratio",
    "boleto_usage_ratio",
)
TARGET = "churned"

# Boosting parameters.
ROUNDS = 200
DEPTH = 5
LEARNING_RATE = 0.1
ROW_SAMPLE = 0.8
TEST_SHARE = 0.2
SEED = 42

SCORED_COLUMNS = (
    "customer_unique_id",
    "state",
    "total_orders",
    "lifetime_revenue",
    "avg_review_score",
    "recency_days",
    "rfm_combined_score",
    "churn_probability",
    "churn_prediction",
    "churn_risk_tier",
    "churned",
)


@dataclass(frozen=True)
class ChurnModel:
    """A fitted classifier with what it needs to score: features in order and their medians."""

    features: tuple[str, ...]
    medians: dict[str, float]
    classifier: GBTClassificationModel
    held_out: DataFrame

    def score(self, customer_360: DataFrame) -> DataFrame:
        """Probability, class and tier of every customer, training rows included."""
        filled = customer_360.select(
            "*", F.struct(*customer_360.columns).alias("_given")
        ).transform(fill_medians, self.medians)
        vectors = VectorAssembler(inputCols=list(self.features), outputCol="_features")
        scored = self.classifier.transform(vectors.transform(filled))
        return (
            scored.select(
                "_given.*",
                vector_to_array("_probability")[1].alias("churn_probability"),
                F.col("_prediction").cast("int").alias("churn_prediction"),
            )
            .withColumn("churn_risk_tier", risk_tier(F.col("churn_probability")))
            .withColumn(TARGET, F.col(TARGET).cast("int"))
            .select(*SCORED_COLUMNS)
        )

    def report(self) -> DataFrame:
        """Classification report on the held-out rows."""
        return classification_report(self.score(self.held_out))

    def trees(self) -> DataFrame:
        """The nodes of all trees; features are numbered in the order of ``features``."""
        return boosted_trees.tree_table(self.held_out.sparkSession, self.classifier)

    def probability_sql(self, source: str) -> str:
        """The model as SQL text: customer_unique_id and churn_probability of the rows of a table."""
        return boosted_trees.probability_sql(
            self.trees(), self.features, self.medians, source, "customer_unique_id"
        )

    def importances(self, top: int = 10, digits: int | None = None) -> DataFrame:
        """The most important features; equal ones stay in feature order.

        With ``digits``, importances are rounded before they are compared.
        """
        named = self.held_out.sparkSession.createDataFrame(
            list(enumerate(self.features)), "position int, name string"
        )
        found = boosted_trees.importances(self.trees())
        weight = F.coalesce("importance", F.lit(0.0))
        return (
            named.join(found, F.col("position") == F.col("feature"), "left")
            .select(
                F.col("name").alias("feature"),
                (weight if digits is None else F.round(weight, digits)).alias("importance"),
                "position",
            )
            .orderBy(F.desc("importance"), "position")
            .limit(top)
            .select("feature", "importance")
        )


def fit_churn_model(
    customer_360: DataFrame,
    rounds: int = ROUNDS,
    exclude_features: Sequence[str] = (),
) -> ChurnModel:
    """Impute, split and fit. ``customer_360`` should be stored data.

    The label is derived from ``total_orders``, which is itself a feature (as is its copy
    ``frequency``), so hold-out figures say little about the model; ``exclude_features`` leaves
    such columns out. The training rows are stored before the fit, in even partitions: each of the
    many passes waits for its largest one, and a lost executor must not change the sample a
    round draws.
    """
    spark = customer_360.sparkSession
    features = tuple(name for name in FEATURES if name not in set(exclude_features))
    medians = exact_medians(customer_360, features)
    split = stratified_split(customer_360, TARGET, "customer_unique_id", TEST_SHARE, SEED)
    use_reliable_checkpoints(spark)
    vectors = VectorAssembler(inputCols=list(features), outputCol="_features")
    training = stage(
        vectors.transform(
            split.filter(~F.col("held_out"))
            .transform(fill_medians, medians)
            .withColumn("_label", F.col(TARGET).cast("double"))
        ).select("_features", "_label").hint("rebalance"),
        "training-rows",
    )
    boosting = GBTClassifier(
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_prediction",
        maxIter=rounds,
        maxDepth=DEPTH,
        stepSize=LEARNING_RATE,
        subsamplingRate=ROW_SAMPLE,
        seed=SEED,
        checkpointInterval=10,
    )
    boosting.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    classifier = boosting.fit(training)
    return ChurnModel(
        features, medians, classifier, split.filter(F.col("held_out")).drop("held_out")
    )


def churn_prediction(customer_360: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Fit on the wide customer table and score all of it."""
    return fit_churn_model(customer_360, rounds).score(customer_360)
