"""Seller scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_diff
from tidemark.functions.numbers import ratio
from tidemark.operators.orders import delivered


def _number(value: Column, exact: bool) -> Column:
    return value.cast("decimal(18,6)" if exact else "double")


def seller_performance(
    sellers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    exact: bool = False,
) -> DataFrame:
    """Sales, reviews and delivery of each seller's delivered orders.

    Measures are defined over items paired with every review of their order, so an item of an
    order with three reviews counts three times in sums, averages and the late numerator, and
    the late rate (late pairs per distinct order) can exceed 1. Pairs are never formed: reviews
    are reduced to one row per order and items carry the number of their pairs as a weight.
    The seller table joins after the aggregation, one row per seller. "Late" compares exact
    timestamps here, unlike the customer features.
    """
    order_reviews = reviews.groupBy("order_id").agg(
        F.count("*").alias("pairs"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
    )
    facts = (
        delivered(orders)
        .select(
            "order_id",
            day_diff("purchased_at", "delivered_at").alias("days"),
            (F.col("delivered_at") > F.col("estimated_delivery_at")).alias("late"),
        )
        .join(order_reviews, "order_id", "left")
        # A computed key hides the partitioning, so the facts are shuffled again for the join
        # with the items. Both inputs are then plain shuffles, which AQE needs to split the
        # items of a hot order over tasks.
        .select(
            F.concat("order_id", F.lit("")).alias("order_id"),
            "days",
            "late",
            F.coalesce("pairs", F.lit(1)).alias("pairs"),
            "score_sum",
            "score_count",
        )
    )

    def weighted(value: Column) -> Column:
        return F.sum(value * F.col("pairs"))

    def present(value: Column) -> Column:
        return F.sum(F.when(value.isNotNull(), F.col("pairs")))

    price = _number(F.col("price"), exact)
    freight = _number(F.col("freight_value"), exact)
    sold = (
        items.select("seller_id", "order_id", "product_id", "price", "freight_value")
        .join(facts, "order_id")
        .groupBy("seller_id")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("product_id").alias("products"),
            weighted(price).cast("double").alias("revenue"),
            present(price).alias("price_count"),
            weighted(freight).cast("double").alias("freight"),
            present(freight).alias("freight_count"),
            F.sum("score_sum").alias("scores"),
            F.sum("score_count").alias("score_count"),
            weighted(F.col("days")).alias("days"),
            present(F.col("days")).alias("day_count"),
            F.sum(F.when(F.col("late"), F.col("pairs")).otherwise(0)).alias("late"),
        )
    )
    # A seller listed n times with the same place counts n times in the sums.
    listed = sellers.groupBy("seller_id", "city", "state").agg(F.count("*").alias("listings"))
    return sold.join(listed, "seller_id").select(
        "seller_id",
        F.col("city").alias("seller_city"),
        F.col("state").alias("seller_state"),
        F.col("orders").alias("total_orders_fulfilled"),
        F.col("products").alias("unique_products_sold"),
        (F.col("revenue") * F.col("listings")).alias("total_revenue"),
        ratio(F.col("revenue"), F.col("price_count")).alias("avg_item_price"),
        ratio(F.col("freight"), F.col("freight_count")).alias("avg_freight_value"),
        ratio(F.col("scores"), F.col("score_count")).alias("avg_review_score"),
        ratio(F.col("days"), F.col("day_count")).alias("avg_delivery_days"),
        ratio(F.col("late") * F.col("listings"), F.col("orders")).alias("late_delivery_rate"),
    )
