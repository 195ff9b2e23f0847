"""The model graph: raw tables to staged tables to features to marts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import customers, orders, segments, sellers, staging
from tidemark.plans.churn_model import ROUNDS, ChurnModel, fit_churn_model
from tidemark.session import apply_defaults, remove_intermediates, stage
from tidemark.sources.category_names import category_names
from tidemark.sources.marts import write_mart


class Analytics:
    """Every model over one set of raw tables, each built when first asked for.

    Models are lazy frames, like views, except where several consumers must read the same
    rows: the order summary, the wide customer table and the scored customers are stored once.
    ``exact`` sums in decimals, so results do not depend on the order rows are added in.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        exact: bool = False,
        rounds: int = ROUNDS,
    ):
        apply_defaults(spark)
        self.spark = spark
        self.raw = raw
        self.exact = exact
        self.rounds = rounds

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw["order_payments"])

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw["order_reviews"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"], category_names(self.spark))

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw["sellers"])

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw["geolocation"], self.exact)

    @cached_property
    def order_enriched(self) -> DataFrame:
        return orders.order_enriched(
            self.stg_orders,
            self.stg_order_items,
            self.stg_order_payments,
            self.stg_order_reviews,
            self.exact,
        )

    @cached_property
    def customer_order_summary(self) -> DataFrame:
        """Stored: scores, labels and the wide table all rank or compare these rows."""
        summary = customers.customer_order_summary(
            self.stg_customers,
            self.stg_orders,
            self.stg_order_items,
            self.stg_order_payments,
            self.stg_order_reviews,
            self.exact,
        )
        return stage(summary, "customer_order_summary")

    @cached_property
    def scored_summary(self) -> DataFrame:
        """The summary with its scores; ranks are found once for all readers."""
        return customers.with_rfm(self.customer_order_summary)

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return self.scored_summary.select(*customers.RFM_COLUMNS)

    @cached_property
    def customer_churn_labels(self) -> DataFrame:
        return customers.customer_churn_labels(self.customer_order_summary)

    @cached_property
    def customer_behavioral_features(self) -> DataFrame:
        return customers.customer_behavioral_features(
            self.stg_order_items,
            self.stg_orders,
            self.stg_customers,
            self.stg_products,
            self.stg_order_payments,
        )

    def customer_360_rows(self) -> DataFrame:
        return customers.customer_360(self.scored_summary, self.customer_behavioral_features)

    @cached_property
    def customer_360(self) -> DataFrame:
        """Stored: the model reads it to impute, split, train and score."""
        return stage(self.customer_360_rows(), "customer_360")

    @cached_property
    def churn_model(self) -> ChurnModel:
        return fit_churn_model(self.customer_360, self.rounds)

    @cached_property
    def churn_prediction(self) -> DataFrame:
        """Stored: every summary of scored customers reads it."""
        return stage(self.churn_model.score(self.customer_360), "churn_prediction")

    @cached_property
    def churn_segment_summary(self) -> DataFrame:
        return segments.churn_segment_summary(self.churn_prediction, self.exact)

    @cached_property
    def seller_performance(self) -> DataFrame:
        return sellers.seller_performance(
            self.stg_sellers,
            self.stg_order_items,
            self.stg_orders,
            self.stg_order_reviews,
            self.exact,
        )

    def close(self) -> None:
        """Delete the intermediate tables of the application; stored marts stay."""
        remove_intermediates(self.spark)

    def build_marts(self, directory: str) -> dict[str, DataFrame]:
        """Rebuild the four marts under ``directory``; each later mart reads the stored earlier."""
        wide = write_mart(self.customer_360_rows(), directory, "customer_360")
        self.customer_360 = wide
        scored = write_mart(self.churn_model.score(wide), directory, "churn_prediction")
        self.churn_prediction = scored
        return {
            "customer_360": wide,
            "churn_prediction": scored,
            "churn_segment_summary": write_mart(
                self.churn_segment_summary, directory, "churn_segment_summary"
            ),
            "seller_performance": write_mart(
                self.seller_performance, directory, "seller_performance"
            ),
        }


MODELS = tuple(
    name for name, member in vars(Analytics).items()
    if isinstance(member, cached_property) and name not in ("scored_summary", "churn_model")
)
