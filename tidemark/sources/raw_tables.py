"""Schemas of the eight raw tables and readers for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RawColumn:
    name: str
    kind: str  # text, int, double or timestamp
    width: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return {
            "text": T.StringType(),
            "int": T.IntegerType(),
            "double": T.DoubleType(),
            "timestamp": T.TimestampNTZType(),
        }[self.kind]


def _text(width: int, *names: str) -> list[RawColumn]:
    return [RawColumn(name, "text", width) for name in names]


def _typed(kind: str, *names: str) -> list[RawColumn]:
    return [RawColumn(name, kind) for name in names]


# Names, order, types and text widths of the raw columns
# (including the raw spelling "lenght").
RAW_TABLES: dict[str, list[RawColumn]] = {
    "customers": [
        *_text(50, "customer_id", "customer_unique_id"),
        *_text(10, "customer_zip_code_prefix"),
        *_text(100, "customer_city"),
        *_text(5, "customer_state"),
    ],
    "orders": [
        *_text(50, "order_id", "customer_id"),
        *_text(20, "order_status"),
        *_typed(
            "timestamp",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ],
    "order_items": [
        *_text(50, "order_id"),
        *_typed("int", "order_item_id"),
        *_text(50, "product_id", "seller_id"),
        *_typed("timestamp", "shipping_limit_date"),
        *_typed("double", "price", "freight_value"),
    ],
    "order_payments": [
        *_text(50, "order_id"),
        *_typed("int", "payment_sequential"),
        *_text(30, "payment_type"),
        *_typed("int", "payment_installments"),
        *_typed("double", "payment_value"),
    ],
    "order_reviews": [
        *_text(50, "review_id", "order_id"),
        *_typed("int", "review_score"),
        *_text(500, "review_comment_title"),
        *_text(5000, "review_comment_message"),
        *_typed("timestamp", "review_creation_date", "review_answer_timestamp"),
    ],
    "products": [
        *_text(50, "product_id"),
        *_text(100, "product_category_name"),
        *_typed(
            "int",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    ],
    "sellers": [
        *_text(50, "seller_id"),
        *_text(10, "seller_zip_code_prefix"),
        *_text(100, "seller_city"),
        *_text(5, "seller_state"),
    ],
    "geolocation": [
        *_text(10, "geolocation_zip_code_prefix"),
        *_typed("double", "geolocation_lat", "geolocation_lng"),
        *_text(100, "geolocation_city"),
        *_text(5, "geolocation_state"),
    ],
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type) for c in RAW_TABLES[table]])


# An empty file that the CSV load leaves in a table's folder.
LOADED_MARKER = "_LOADED_FROM_CSV"


def loaded_schema(columns: T.StructType) -> T.StructType:
    """What a CSV load stores: typed columns, or the rejected row as text with the reason."""
    texts = [T.StructField(name, T.StringType()) for name in ["reason", "line", *columns.names]]
    return T.StructType(
        [
            *columns.fields,
            T.StructField("reject", T.StructType(texts)),
            T.StructField("rejected", T.BooleanType()),
        ]
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm_path.getFileSystem(conf).exists(jvm_path)


def load_raw(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The eight raw tables from ``<directory>/<table>``, as loaded from CSV or plain parquet.

    A table that the CSV load has stored, known by its marker, is read with its schema and without
    the rows set aside, also when none was kept; of any other the named columns are taken.
    """
    return {table: _load_one(spark, f"{directory}/{table}", table) for table in RAW_TABLES}


def _load_one(spark: SparkSession, path: str, table: str) -> DataFrame:
    names = [column.name for column in RAW_TABLES[table]]
    if path_exists(spark, f"{path}/{LOADED_MARKER}"):
        stored = spark.read.schema(loaded_schema(raw_schema(table))).parquet(path)
        return stored.filter(~F.col("rejected")).select(*names)
    return spark.read.parquet(path).select(*names)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, in name order."""
    if not tables:
        return SparkSession.active().createDataFrame([], "table_name string, row_count long")
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy("table_name")
