"""The raw tables derived from order/lineitem-style benchmark tables by fixed arithmetic.

Every raw row comes from a row of the given tables; the rules are in FIXTURES.md section 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Part type to raw category name; pc_gamer has no English name in the lookup.
CATEGORY_OF_TYPE = {
    "ECONOMY": "beleza_saude",
    "LARGE": "informatica_acessorios",
    "MEDIUM": "automotivo",
    "PROMO": "cama_mesa_banho",
    "STANDARD": "moveis_decoracao",
    "SMALL": "pc_gamer",
}
STATUS_OF_ORDER = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_OF_FLAG = {"R": "credit_card", "A": "boleto", "N": "voucher"}


def _lookup(column: str, values: dict[str, str]) -> Column:
    chosen = None
    for key, value in values.items():
        hit = F.col(column) == key
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _after(start: Column, hours: Column | int) -> Column:
    return start + F.make_dt_interval(hours=hours if isinstance(hours, Column) else F.lit(hours))


def _hours(expression: Column) -> Column:
    return expression.cast("int")


def raw_tables_from_tpch(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}.parquet")

    orders, lineitem, customer = table("orders"), table("lineitem"), table("customer")
    nation, region = table("nation"), table("region")

    key = F.col("o_orderkey")
    purchase = _after(F.col("o_orderdate"), _hours(key % 24))
    on_the_way = _hours(key % 24 + 24 * (1 + key % 20) + key % 7)
    return {
        "customers": orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("o_orderkey").alias("customer_id"),
            _text("o_custkey").alias("customer_unique_id"),
            _text("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        ),
        "orders": orders.select(
            _text("o_orderkey").alias("order_id"),
            _text("o_orderkey").alias("customer_id"),
            _lookup("o_orderstatus", STATUS_OF_ORDER).alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
            _after(purchase, 1).alias("order_approved_at"),
            _after(purchase, _hours(1 + key % 5)).alias("order_delivered_carrier_date"),
            F.when(key % 97 != 0, _after(F.col("o_orderdate"), on_the_way)).alias(
                "order_delivered_customer_date"
            ),
            _after(F.col("o_orderdate"), 14 * 24).alias("order_estimated_delivery_date"),
        ),
        "order_items": lineitem.select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        ),
        "order_payments": lineitem.select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            _lookup("l_returnflag", PAYMENT_OF_FLAG).alias("payment_type"),
            (F.col("l_quantity").cast("int") % 10 + 1).alias("payment_installments"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"),
        ),
        "order_reviews": lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
            _text("l_orderkey").alias("order_id"),
            # whole orders without a score, so that persons without one occur
            F.when(
                F.col("l_orderkey") % 4 != 0, F.col("l_quantity").cast("int") % 5 + 1
            ).alias("review_score"),
            F.concat("l_returnflag", "l_linestatus").alias("review_comment_title"),
            F.when(
                F.col("l_linenumber") % 3 != 0,
                F.concat(F.lit('said "'), "l_linestatus", F.lit('", part '), _text("l_partkey")),
            ).alias("review_comment_message"),
            F.col("l_shipdate").alias("review_creation_date"),
            _after(F.col("l_shipdate"), 24).alias("review_answer_timestamp"),
        ),
        "products": table("part").select(
            _text("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, _lookup("p_type", CATEGORY_OF_TYPE)).alias(
                "product_category_name"
            ),
            F.length("p_name").alias("product_name_lenght"),
            (F.length("p_name") * 10).alias("product_description_lenght"),
            (F.col("p_size") % 6 + 1).alias("product_photos_qty"),
            (F.col("p_size") * 100).alias("product_weight_g"),
            (F.col("p_size") + 10).alias("product_length_cm"),
            (F.col("p_size") + 5).alias("product_height_cm"),
            (F.col("p_size") + 8).alias("product_width_cm"),
        ),
        "sellers": table("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("s_suppkey").alias("seller_id"),
            _text("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        ),
        "geolocation": customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.lpad((F.col("c_custkey") % 200).cast("string"), 5, "0").alias(
                "geolocation_zip_code_prefix"
            ),
            (-F.col("c_acctbal") / 1000).alias("geolocation_lat"),
            (F.col("c_acctbal") / 500).alias("geolocation_lng"),
            F.col("c_mktsegment").alias("geolocation_city"),
            F.col("n_name").alias("geolocation_state"),
        ),
    }
