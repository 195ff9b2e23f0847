"""Order-level aggregates and the enriched delivered order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_diff
from tidemark.functions.numbers import mean, total


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered")


def order_items_agg(items: DataFrame, exact: bool = False) -> DataFrame:
    """Items, distinct products and sellers, price and freight of every order.

    Two distinct counts in one aggregate would triple the rows before they are reduced, so sellers are
    counted apart and the two rows of an order put together. What a reader does not use is not computed.
    """
    measured = items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.countDistinct("product_id").alias("unique_products"),
        total(F.col("price"), exact).alias("total_price"),
        total(F.col("freight_value"), exact).alias("total_freight"),
    )
    sellers = items.groupBy("order_id").agg(F.countDistinct("seller_id").alias("unique_sellers"))
    names = ("item_count", "unique_products", "unique_sellers", "total_price", "total_freight")
    return (
        measured.unionByName(sellers, allowMissingColumns=True)
        .groupBy("order_id")
        .agg(*[F.max(name).alias(name) for name in names])
    )


def order_item_counts(items: DataFrame) -> DataFrame:
    """The number of items of every order."""
    return items.groupBy("order_id").agg(F.count("*").alias("item_count"))


def order_payments_agg(payments: DataFrame, exact: bool = False) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.countDistinct("payment_type").alias("payment_type_count"),
        F.max("payment_installments").alias("max_installments"),
        total(F.col("payment_value"), exact).alias("total_payment"),
    )


def order_reviews_agg(reviews: DataFrame, exact: bool = False) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        mean(F.col("review_score"), exact).alias("avg_review_score"),
        F.min("review_score").alias("min_review_score"),
    )


def with_order_details(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    exact: bool = False,
    only_count_items: bool = False,
) -> DataFrame:
    """Add day differences and the item, payment and review aggregates to order rows.

    Each detail table is reduced to its order first, so no join multiplies rows, and the three are
    joined to one another on the partitioning that the aggregates already have. A computed key then
    hides it, so that both sides of the last join are plain shuffles: AQE splits the rows of a null or
    repeated ``order_id`` over tasks, which it cannot do where an aggregate needs them together.
    A negative ``delivery_delta_days`` means late. ``only_count_items`` leaves ``item_count`` as the
    only item aggregate, which needs no grouping by product and seller.
    """
    known = F.col("order_id").isNotNull()
    known_items = items.filter(known)
    of_items = order_item_counts(known_items) if only_count_items else order_items_agg(known_items, exact)
    details = (
        of_items
        .join(order_payments_agg(payments.filter(known), exact), "order_id", "full")
        .join(order_reviews_agg(reviews.filter(known), exact), "order_id", "full")
        .withColumn("order_id", F.concat("order_id", F.lit("")))
    )
    return orders.select(
        "*",
        day_diff("purchased_at", "delivered_at").alias("delivery_days"),
        day_diff("purchased_at", "estimated_delivery_at").alias("estimated_delivery_days"),
        day_diff("delivered_at", "estimated_delivery_at").alias("delivery_delta_days"),
    ).join(details, "order_id", "left")


def order_enriched(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    exact: bool = False,
) -> DataFrame:
    """One row per delivered order with its lifecycle, day differences and detail aggregates."""
    return with_order_details(delivered(orders), items, payments, reviews, exact).select(
        "order_id",
        "customer_id",
        "purchased_at",
        "approved_at",
        "shipped_at",
        "delivered_at",
        "estimated_delivery_at",
        "delivery_days",
        "estimated_delivery_days",
        "delivery_delta_days",
        "item_count",
        "unique_products",
        "unique_sellers",
        "total_price",
        "total_freight",
        "payment_type_count",
        "max_installments",
        "total_payment",
        "avg_review_score",
        "min_review_score",
    )
