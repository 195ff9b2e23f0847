"""Hand-made raw tables for the tests."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from tidemark.operators import staging
from tidemark.sources.category_names import category_names
from tidemark.sources.raw_tables import RAW_TABLES, raw_schema


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def raw(spark, table: str, rows: list[dict]):
    """A raw table from rows that name only the columns they care about."""
    names = [column.name for column in RAW_TABLES[table]]
    unknown = {name for row in rows for name in row} - set(names)
    assert not unknown, unknown
    return spark.createDataFrame(
        [tuple(row.get(name) for name in names) for row in rows], raw_schema(table)
    )


def order(key, customer=None, bought="2020-01-01 10:00:00", got=None, due=None, status="delivered"):
    return {
        "order_id": key,
        "customer_id": customer or key,
        "order_status": status,
        "order_purchase_timestamp": at(bought),
        "order_delivered_customer_date": at(got),
        "order_estimated_delivery_date": at(due),
    }


def person(customer_id, unique_id, city="C", state="S"):
    return {
        "customer_id": customer_id,
        "customer_unique_id": unique_id,
        "customer_city": city,
        "customer_state": state,
    }


def item(key, product="p", seller="s", price=10.0, freight=1.0):
    return {
        "order_id": key,
        "product_id": product,
        "seller_id": seller,
        "price": price,
        "freight_value": freight,
    }


def payment(key, kind="credit_card", value=10.0, installments=1):
    return {
        "order_id": key,
        "payment_type": kind,
        "payment_value": value,
        "payment_installments": installments,
    }


def review(key, score, name=None):
    return {"review_id": name or f"{key}-{score}", "order_id": key, "review_score": score}


class Shop:
    """Staged tables over hand-made rows."""

    def __init__(
        self, spark, orders=(), customers=(), items=(), payments=(), reviews=(), products=(),
        sellers=(),
    ):
        self.orders = staging.stg_orders(raw(spark, "orders", list(orders)))
        self.customers = staging.stg_customers(raw(spark, "customers", list(customers)))
        self.items = staging.stg_order_items(raw(spark, "order_items", list(items)))
        self.payments = staging.stg_order_payments(raw(spark, "order_payments", list(payments)))
        self.reviews = staging.stg_order_reviews(raw(spark, "order_reviews", list(reviews)))
        self.products = staging.stg_products(
            raw(spark, "products", list(products)), category_names(spark)
        )
        self.sellers = staging.stg_sellers(raw(spark, "sellers", list(sellers)))

    @property
    def order_tables(self):
        return self.orders, self.items, self.payments, self.reviews


def by(df, key: str) -> dict:
    """Rows of a small frame by their key."""
    return {row[key]: row for row in df.collect()}


# A cluster's skew handling at the size of a test: no broadcast, and "large" means kilobytes.
SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextmanager
def settings(spark, values: dict[str, str]):
    """SQL settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
