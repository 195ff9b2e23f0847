from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.shop import SMALL_PARTITIONS, Shop, by, item, order, review, settings
from tidemark.operators.sellers import seller_performance


def scorecard(shop, exact=False):
    return seller_performance(shop.sellers, shop.items, shop.orders, shop.reviews, exact)


def paired_definition(shop):
    """The measures over items paired with reviews, spelled out as joins."""
    o = shop.orders.filter("order_status = 'delivered'")
    rows = (
        shop.sellers.join(shop.items, "seller_id")
        .join(o, "order_id")
        .join(shop.reviews.select("order_id", "review_score"), "order_id", "left")
    )
    late = F.when(F.col("delivered_at") > F.col("estimated_delivery_at"), 1).otherwise(0)
    return rows.groupBy("seller_id", "city", "state").agg(
        F.countDistinct("order_id").alias("total_orders_fulfilled"),
        F.countDistinct("product_id").alias("unique_products_sold"),
        F.sum("price").alias("total_revenue"),
        F.avg("price").alias("avg_item_price"),
        F.avg("freight_value").alias("avg_freight_value"),
        F.avg("review_score").alias("avg_review_score"),
        F.avg(F.datediff("delivered_at", "purchased_at")).alias("avg_delivery_days"),
        (F.sum(late) / F.countDistinct("order_id")).alias("late_delivery_rate"),
    )


def seller(name, city="c", state="s"):
    return {"seller_id": name, "seller_city": city, "seller_state": state}


def test_pairs_of_items_and_reviews_count(spark):
    shop = Shop(
        spark,
        sellers=[seller("s")],
        orders=[order("1", got="2020-01-10 12:00:00", due="2020-01-10 00:00:00")],
        items=[item("1", "a", price=10.0), item("1", "b", price=20.0)],
        reviews=[review("1", 5), review("1", 2)],
    )
    row = scorecard(shop).first()
    assert row.late_delivery_rate == 4.0  # late by timestamp, four pairs, one order
    assert row.total_revenue == 60.0
    assert row.total_orders_fulfilled == 1 and row.unique_products_sold == 2
    assert row.avg_review_score == 3.5 and row.avg_delivery_days == 9.0


@pytest.mark.parametrize("exact", [False, True])
def test_weights_equal_the_paired_definition(spark, exact):
    orders, items, reviews = [], [], []
    for n in range(40):
        got = None if n % 7 == 0 else f"2020-01-{5 + n % 20:02d} 12:00:00"
        status = "shipped" if n % 11 == 0 else "delivered"
        orders.append(order(str(n), got=got, due="2020-01-15 00:00:00", status=status))
        for k in range(1 + n % 3):
            price = None if (n + k) % 9 == 0 else 1.25 * n + k
            items.append(item(str(n), f"p{n % 6}", f"s{(n + k) % 4}", price, 0.5 * k))
        for k in range(n % 4):
            reviews.append(review(str(n), None if (n + k) % 8 == 0 else 1 + (n + k) % 5, f"{n}.{k}"))
    items.append(item("1", "p", None))
    shop = Shop(
        spark,
        sellers=[seller("s0"), seller("s1"), seller("s1"), seller("s2"), seller("s2", "other"),
                 seller("idle")],
        orders=orders, items=items, reviews=reviews,
    )
    got = {(r.seller_id, r.seller_city): r for r in scorecard(shop, exact).collect()}
    want = {(r.seller_id, r.city): r for r in paired_definition(shop).collect()}
    assert set(got) == set(want) and len(got) == 4
    for key, row in want.items():
        for name in row.asDict().keys() - {"city", "state"}:
            assert got[key][name] == pytest.approx(row[name]), (key, name)


def test_a_hot_order_is_split_over_tasks(spark):
    """Items of one order hold a third of all rows; AQE must cut their join partition."""
    n = 30_000
    shop = Shop(spark, sellers=[seller(f"s{k}") for k in range(5)])
    ids = spark.range(n)
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    shop.items = ids.select(
        hot.alias("order_id"), F.concat(F.lit("p"), F.col("id") % 50).alias("product_id"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("seller_id"),
        (F.col("id") % 10).cast("double").alias("price"),
        F.rpad(F.col("id").cast("string"), 8, "7").cast("double").alias("freight_value"),
    )
    stamps = "timestamp_ntz'2020-01-01 00:00:00'"
    shop.orders = shop.items.select("order_id").distinct().select(
        "order_id", F.lit("delivered").alias("order_status"),
        F.expr(stamps).alias("purchased_at"), F.expr(stamps).alias("delivered_at"),
        F.expr(stamps).alias("estimated_delivery_at"),
    )
    with settings(spark, SMALL_PARTITIONS):
        df = scorecard(shop)
        rows = by(df, "seller_id")
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == 5
    assert sum(row.total_revenue for row in rows.values()) == pytest.approx(4.5 * n)
