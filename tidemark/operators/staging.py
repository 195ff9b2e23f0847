"""Cleaned, typed and renamed versions of the raw tables, one function per table.

All are projections that fuse into the scans of whatever reads them; only the location table
aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import (
    NUMBER_TEXT,
    TIMESTAMP_TEXT,
    checked_text,
    ratio,
    total,
    whole_number,
)


def _timestamp(raw: DataFrame, name: str, alias: str) -> Column:
    return checked_text(raw, name, TIMESTAMP_TEXT).cast("timestamp_ntz").alias(alias)


def _double(raw: DataFrame, name: str) -> Column:
    return checked_text(raw, name, NUMBER_TEXT).cast("double").alias(name)


def _place(prefix: str) -> list[Column]:
    return [
        F.col(f"{prefix}_zip_code_prefix").cast("string").alias("zip_code"),
        F.col(f"{prefix}_city").alias("city"),
        F.col(f"{prefix}_state").alias("state"),
    ]


def stg_customers(raw: DataFrame) -> DataFrame:
    """``customer_id`` identifies one order's customer record, ``customer_unique_id`` the person."""
    return raw.select("customer_id", "customer_unique_id", *_place("customer"))


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select("seller_id", *_place("seller"))


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        _timestamp(raw, "order_purchase_timestamp", "purchased_at"),
        _timestamp(raw, "order_approved_at", "approved_at"),
        _timestamp(raw, "order_delivered_carrier_date", "shipped_at"),
        _timestamp(raw, "order_delivered_customer_date", "delivered_at"),
        _timestamp(raw, "order_estimated_delivery_date", "estimated_delivery_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        whole_number(raw, "order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        _timestamp(raw, "shipping_limit_date", "shipping_limit_at"),
        _double(raw, "price"),
        _double(raw, "freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        whole_number(raw, "payment_sequential").alias("payment_sequential"),
        "payment_type",
        whole_number(raw, "payment_installments").alias("payment_installments"),
        _double(raw, "payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        whole_number(raw, "review_score").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        _timestamp(raw, "review_creation_date", "review_created_at"),
        _timestamp(raw, "review_answer_timestamp", "review_answered_at"),
    )


def stg_products(raw: DataFrame, category_names: DataFrame) -> DataFrame:
    """English category where the lookup knows it, else the raw one.

    The lookup is a fixed list of 71 rows, so it is broadcast.
    """
    whole = {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
        "product_photos_qty": "product_photos_count",
        "product_weight_g": "product_weight_grams",
        "product_length_cm": "product_length_cm",
        "product_height_cm": "product_height_cm",
        "product_width_cm": "product_width_cm",
    }
    return raw.join(F.broadcast(category_names), "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name").alias(
            "product_category"
        ),
        *[whole_number(raw, source).alias(target) for source, target in whole.items()],
    )


def stg_geolocation(raw: DataFrame, exact: bool = False) -> DataFrame:
    """One row per zip code: mean position, last city and state in binary text order.

    Points are first summed per place name: text maxima need a sort-based aggregate, which then
    sees a few rows per zip code instead of every point.
    """
    latitude = checked_text(raw, "geolocation_lat", NUMBER_TEXT).cast("double")
    longitude = checked_text(raw, "geolocation_lng", NUMBER_TEXT).cast("double")
    named = raw.groupBy(
        F.col("geolocation_zip_code_prefix").cast("string").alias("zip_code"),
        "geolocation_city",
        "geolocation_state",
    ).agg(
        total(latitude, exact).alias("latitudes"),
        F.count(latitude).alias("latitude_count"),
        total(longitude, exact).alias("longitudes"),
        F.count(longitude).alias("longitude_count"),
    )
    return named.groupBy("zip_code").agg(
        ratio(total(F.col("latitudes"), exact), F.sum("latitude_count")).alias("latitude"),
        ratio(total(F.col("longitudes"), exact), F.sum("longitude_count")).alias("longitude"),
        F.max("geolocation_city").alias("city"),
        F.max("geolocation_state").alias("state"),
    )
