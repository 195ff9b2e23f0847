from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.shop import SMALL_PARTITIONS, Shop, by, item, order, payment, person, review, settings
from tidemark.operators import customers, orders
from tidemark.operators.orders import order_enriched
from tidemark.session import stage


def summary_of(shop: Shop):
    return customers.customer_order_summary(shop.customers, *shop.order_tables)


def test_only_delivered_orders_and_no_row_multiplication(spark):
    shop = Shop(
        spark,
        orders=[order("1"), order("2", status="shipped"), order("3")],
        items=[item("1", "p1", "s1", 10.0), item("1", "p1", "s2", 5.0), item("2")],
        payments=[payment("1", "boleto", 7.0, 2), payment("1", "voucher", 8.0, 5)],
        reviews=[review("1", 5), review("1", 2)],
    )
    rows = by(order_enriched(*shop.order_tables), "order_id")
    assert set(rows) == {"1", "3"}
    one = rows["1"]
    assert (one.item_count, one.unique_products, one.unique_sellers) == (2, 1, 2)
    assert (one.total_price, one.total_freight) == (15.0, 2.0)
    assert (one.payment_type_count, one.max_installments, one.total_payment) == (2, 5, 15.0)
    assert (one.avg_review_score, one.min_review_score) == (3.5, 2)
    assert rows["3"].item_count is None and rows["3"].total_payment is None


def test_delivery_delta_is_negative_when_late(spark):
    shop = Shop(
        spark,
        orders=[order("1", bought="2020-01-01 23:00:00", got="2020-01-12 01:00:00",
                      due="2020-01-10 00:00:00")],
    )
    row = order_enriched(*shop.order_tables).first()
    assert row.delivery_delta_days == -2
    assert row.delivery_days == 11
    assert row.estimated_delivery_days == 9


def test_summary_averages_are_over_orders(spark):
    shop = Shop(
        spark,
        orders=[order("1"), order("2"), order("3")],
        customers=[person("1", "A"), person("2", "A"), person("3", "A")],
        payments=[payment("1", value=10.0), payment("2", value=30.0)],
        reviews=[review("1", 1), review("2", 5, "a"), review("2", 5, "b"), review("2", 2)],
    )
    row = summary_of(shop).first()
    assert row.total_orders == 3
    assert row.avg_review_score == 2.5  # mean of 1 and 4, not of the four scores
    assert row.avg_order_value == 20.0  # the unpaid order does not count
    assert row.lifetime_revenue == 40.0
    assert row.worst_review_score == 1
    assert row.total_items_purchased is None


def test_city_and_state_are_each_first_in_text_order(spark):
    shop = Shop(
        spark,
        orders=[order("1"), order("2")],
        customers=[person("1", "A", "B", "X"), person("2", "A", "A", "Y")],
    )
    row = summary_of(shop).first()
    assert (row.city, row.state) == ("A", "X")


def test_repeated_order_rows_count_once(spark):
    shop = Shop(
        spark,
        orders=[order("1"), order("1")],
        customers=[person("1", "A")],
        payments=[payment("1", value=10.0)],
    )
    row = summary_of(shop).first()
    assert (row.total_orders, row.lifetime_revenue) == (1, 20.0)


def test_same_day_is_on_time_for_the_customer(spark):
    shop = Shop(
        spark,
        orders=[order("1", got="2020-01-10 12:00:00", due="2020-01-10 00:00:00"),
                order("2", got="2020-01-11 00:00:00", due="2020-01-10 00:00:00")],
        customers=[person("1", "A"), person("2", "A")],
    )
    assert summary_of(shop).first().late_delivery_count == 1


def rfm_inputs(spark, rows):
    """A stored summary from (id, orders, last order, revenue)."""
    from tests.shop import at

    df = spark.createDataFrame(
        [(name, orders, at(last), at(last), revenue) for name, orders, last, revenue in rows],
        "customer_unique_id string, total_orders long, first_order_at timestamp_ntz, "
        "last_order_at timestamp_ntz, lifetime_revenue double",
    )
    return stage(df, "test-summary")


def test_missing_revenue_ranks_highest(spark):
    rows = [(f"c{n}", 1, f"2020-01-{n + 1:02d}", float(n)) for n in range(9)]
    rows.append(("c9", 1, "2020-01-10", None))
    scored = by(customers.customer_rfm(rfm_inputs(spark, rows)), "customer_unique_id")
    assert scored["c9"].monetary_score == 5
    assert scored["c0"].monetary_score == 1
    assert scored["c9"].recency_score == 5 and scored["c0"].recency_score == 1
    assert all(3 <= row.rfm_combined_score <= 15 for row in scored.values())


def test_ties_follow_the_id(spark):
    rows = [(f"c{n}", 1, "2020-01-01", 1.0) for n in range(7)]
    scored = by(customers.customer_rfm(rfm_inputs(spark, rows)), "customer_unique_id")
    assert [scored[f"c{n}"].frequency_score for n in range(7)] == [1, 1, 2, 2, 3, 4, 5]


def test_label_window_edges(spark):
    rows = [
        ("edge", 1, "2020-01-01 23:59:00", 1.0),
        ("inside", 2, "2020-01-02 00:00:00", 1.0),
        ("last", 2, "2020-03-31 00:01:00", 1.0),
        ("older", 2, "2019-01-01 00:00:00", 1.0),
    ]
    labels = by(customers.customer_churn_labels(rfm_inputs(spark, rows)), "customer_unique_id")
    assert set(labels) == {"edge", "older"}
    assert labels["edge"].days_since_last_order == 90
    assert labels["edge"].churned == 1 and labels["older"].churned == 0
    assert labels["edge"].has_sufficient_window is True
    wider = customers.customer_churn_labels(rfm_inputs(spark, rows), window_days=91)
    assert set(by(wider, "customer_unique_id")) == {"older"}


def test_behavioural_features(spark):
    shop = Shop(
        spark,
        orders=[order("1"), order("2"), order("3"), order("4"), order("5", status="shipped")],
        customers=[person("1", "A"), person("2", "A"), person("3", "B"), person("4", "C"),
                   person("5", "A")],
        items=[item("1", "x"), item("1", "y"), item("2", "x"), item("3", "lost"), item("4", "n"),
               item("5", "z")],
        payments=[payment("1", "credit_card"), payment("1", "boleto"), payment("2", "credit_card"),
                  payment("2", None), payment("3"), payment("5", "voucher")],
        products=[
            {"product_id": "x", "product_category_name": "artes"},
            {"product_id": "y", "product_category_name": "artes"},
            {"product_id": "z", "product_category_name": "bebes"},
            {"product_id": "n"},
        ],
    )
    rows = by(
        customers.customer_behavioral_features(
            shop.items, shop.orders, shop.customers, shop.products, shop.payments
        ),
        "customer_unique_id",
    )
    assert set(rows) == {"A", "C"}  # B bought only an unknown product
    a, c = rows["A"], rows["C"]
    assert (a.unique_categories_purchased, a.unique_products_purchased) == (1, 2)
    assert (a.unique_payment_methods, a.credit_card_usage_ratio, a.boleto_usage_ratio) == (
        2, 0.5, 0.25,
    )
    assert (c.unique_categories_purchased, c.unique_products_purchased) == (0, 1)
    assert c.unique_payment_methods is None and c.credit_card_usage_ratio is None


def test_wide_table_equals_the_joined_definition(spark):
    """The in-place table holds what joining summary, scores, labels and behaviour gives."""
    orders, people, items, payments = [], [], [], []
    for n in range(60):
        month, who = 1 + n % 9, f"u{n % 23}"
        orders.append(order(str(n), bought=f"2020-{month:02d}-{1 + n % 27:02d} 08:00:00"))
        people.append(person(str(n), who, state=f"S{n % 3}"))
        items.append(item(str(n), f"p{n % 5}"))
        if n % 4:
            payments.append(payment(str(n), value=float(n)))
    people[7]["customer_unique_id"] = None
    shop = Shop(
        spark, orders=orders, customers=people, items=items, payments=payments,
        products=[{"product_id": f"p{n}", "product_category_name": "artes"} for n in range(4)],
    )
    summary = stage(summary_of(shop), "test-summary")
    behaviour = customers.customer_behavioral_features(
        shop.items, shop.orders, shop.customers, shop.products, shop.payments
    )
    wide = customers.customer_360(customers.with_rfm(summary), behaviour)
    key = "customer_unique_id"
    joined = (
        summary.join(customers.customer_rfm(summary).drop("total_orders"), key)
        .join(customers.customer_churn_labels(summary).drop("total_orders", "last_order_at"), key)
        .join(behaviour, key, "left")
        .withColumn("customer_tenure_days", F.datediff("last_order_at", "first_order_at"))
        .select(*wide.columns)
    )
    assert len(wide.columns) == 27
    assert wide.count() == joined.count() > 0
    assert wide.exceptAll(joined).count() == 0
    labelled = customers.customer_churn_labels(summary).filter(F.col(key).isNotNull())
    assert wide.count() == labelled.count()


def test_hot_keys_are_split_and_counted_right(spark):
    """One order and one product hold a third of all items, one person a third of all orders."""
    n = 30_000
    shop = Shop(spark)
    ids = spark.range(n)

    def often(column, other, third):
        hot = F.when(F.col("id") % 3 == third, "hot")
        return hot.otherwise(F.concat(F.lit(other), "id")).alias(column)

    shop.items = ids.select(often("order_id", "o", 0), often("product_id", "p", 1))
    shop.payments = ids.select(
        often("order_id", "o", 0),
        F.when(F.col("id") % 2 == 0, "boleto").otherwise("voucher").alias("payment_type"),
    )
    shop.products = ids.select(
        often("product_id", "p", 1), F.concat(F.lit("c"), F.col("id") % 7).alias("product_category")
    ).dropDuplicates(["product_id"])
    shop.orders = shop.items.select("order_id").distinct().select(
        "order_id", F.col("order_id").alias("customer_id"), F.lit("delivered").alias("order_status")
    )
    shop.customers = shop.orders.select(
        "customer_id",
        F.when(F.col("customer_id").endswith("1"), "hot").otherwise(F.col("customer_id")).alias(
            "customer_unique_id"
        ),
    )
    for name in ("items", "orders", "customers", "products", "payments"):
        setattr(shop, name, stage(getattr(shop, name), f"hot-{name}"))
    with settings(spark, SMALL_PARTITIONS):
        df = customers.customer_behavioral_features(
            shop.items, shop.orders, shop.customers, shop.products, shop.payments
        )
        rows = by(df, "customer_unique_id")
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("skew=true") >= 2  # items by order and by product
    endings = [i for i in range(n) if i % 3 and i % 10 == 1]
    hot = rows["hot"]
    assert hot.unique_products_purchased == n // 3 + 1 + sum(i % 3 == 2 for i in endings)
    assert hot.unique_categories_purchased == 7
    evens = sum(1 for i in range(0, n, 3) if i % 2 == 0)
    assert hot.boleto_usage_ratio == evens / (n // 3 + len(endings))
    assert len(rows) == 1 + sum(1 for i in range(n) if i % 3 and i % 10 != 1)


@pytest.mark.parametrize("key", [None, "hot"])
def test_a_null_or_repeated_order_id_is_split_over_tasks(spark, key):
    """A third of all orders have no id, or the same one: their partition is cut, the rows are right."""
    n = 30_000
    ids = stage(spark.range(n), "ids")
    often = F.when(F.col("id") % 3 == 0, F.lit(key)).otherwise(F.concat(F.lit("o"), "id"))
    stamp = F.expr("timestamp_ntz'2020-01-01 00:00:00'")
    rows = ids.select(
        often.cast("string").alias("order_id"), F.concat(F.lit("c"), "id").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[stamp.alias(f"{name}_at") for name in
          ("purchased", "approved", "shipped", "delivered", "estimated_delivery")],
        F.rpad(F.col("id").cast("string"), 40, "7").alias("more"),
    )
    given = stage(rows, "hot-orders")
    details = ids.filter("id % 3 <> 1").select(often.cast("string").alias("order_id"))
    items = stage(details.selectExpr("order_id", "'p' product_id", "'s' seller_id", "1.0D price", "2.0D freight_value"), "hot-items")
    payments = stage(details.selectExpr("order_id", "'x' payment_type", "1 payment_installments", "3.0D payment_value"), "hot-pays")
    reviews = stage(details.selectExpr("order_id", "4 review_score"), "hot-reviews")
    with settings(spark, SMALL_PARTITIONS):
        df = orders.with_order_details(given, items, payments, reviews)
        found = stage(df, "hot-details")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert found.count() == n
    sums = found.groupBy("total_price").count().collect()
    of = {row[0]: row[1] for row in sums}
    # orders with id 1 modulo 3 have no details, those with id 2 one of each
    third = n // 3
    assert of == ({None: 2 * third, 1.0: third} if key is None else {None: third, 1.0: third, float(third): third})
