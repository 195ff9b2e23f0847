"""Per-person features: order summary, recency/frequency/monetary scores, behaviour, churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_diff
from tidemark.functions.numbers import mean, ratio, total
from tidemark.operators.orders import delivered, with_order_details
from tidemark.operators.quantiles import Score, with_ntiles

OBSERVATION_DAYS = 90

RFM_SCORES = (
    Score("recency_score", "recency_days", descending=True),
    Score("frequency_score", "frequency"),
    Score("monetary_score", "monetary"),
)

RFM_COLUMNS = (
    "customer_unique_id",
    "recency_days",
    "frequency",
    "monetary",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_combined_score",
)


def customer_order_summary(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    exact: bool = False,
) -> DataFrame:
    """One row per person with a delivered order.

    Averages are taken over orders: ``avg_review_score`` is a mean of order means, and
    ``avg_order_value`` leaves out orders without a payment. City and state are the first in
    text order, each on its own.

    Persons are attached to the narrow order rows before the details: the rows then arrive
    partitioned by ``order_id``, which the distinct count of orders needs anyway, and only its
    per-person partial results are shuffled once more.
    """
    persons = customers.select("customer_id", "customer_unique_id", "city", "state")
    bought = delivered(orders).join(persons, "customer_id")
    return (
        with_order_details(bought, items, payments, reviews, exact, only_count_items=True)
        .groupBy("customer_unique_id")
        .agg(
            F.min("city").alias("city"),
            F.min("state").alias("state"),
            F.countDistinct("order_id").alias("total_orders"),
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("last_order_at"),
            total(F.col("total_payment"), exact).alias("lifetime_revenue"),
            mean(F.col("total_payment"), exact).alias("avg_order_value"),
            F.sum("item_count").alias("total_items_purchased"),
            mean(F.col("delivery_days"), exact).alias("avg_delivery_days"),
            mean(F.col("delivery_delta_days"), exact).alias("avg_delivery_delta_days"),
            mean(F.col("avg_review_score"), exact).alias("avg_review_score"),
            F.min("min_review_score").alias("worst_review_score"),
            mean(F.col("max_installments"), exact).alias("avg_installments"),
            F.count(F.when(F.col("delivery_delta_days") < 0, 1)).alias("late_delivery_count"),
        )
    )


def dataset_boundary(summary: DataFrame) -> DataFrame:
    """One row: the moment of the last delivered purchase of anyone."""
    return summary.agg(F.max("last_order_at").alias("max_order_date"))


def _boundary(rows: DataFrame) -> Column:
    return dataset_boundary(rows).scalar()


def with_rfm(summary: DataFrame) -> DataFrame:
    """Add recency, frequency and monetary values, their quintiles and the quintile sum.

    Quintiles rank all persons, so this comes before any filter on labels. 5 is best: most
    recent, most orders, most revenue. Persons without any payment have no revenue; they rank
    as the largest. Equal values are ordered by ``customer_unique_id``. ``summary`` should be
    stored data (see ``with_ntiles``).
    """
    measured = summary.select(
        "*",
        day_diff("last_order_at", _boundary(summary)).alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.col("lifetime_revenue").alias("monetary"),
    )
    return with_ntiles(measured, RFM_SCORES, "customer_unique_id").withColumn(
        "rfm_combined_score",
        F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"),
    )


def customer_rfm(summary: DataFrame) -> DataFrame:
    return with_rfm(summary).select(*RFM_COLUMNS)


def with_churn_label(rows: DataFrame, window_days: int = OBSERVATION_DAYS) -> DataFrame:
    """Add the label columns and keep persons observed for at least ``window_days``.

    ``rows`` holds all persons, as their latest order is the end of observation. A person with a
    single order counts as churned.
    """
    observed = day_diff("last_order_at", "max_order_date")
    return (
        rows.withColumn("max_order_date", _boundary(rows))
        .withColumn("days_since_last_order", observed)
        .withColumn("has_sufficient_window", F.coalesce(observed >= window_days, F.lit(False)))
        .withColumn("churned", F.when(F.col("total_orders") == 1, 1).otherwise(0))
        .filter("has_sufficient_window")
    )


def customer_churn_labels(
    summary: DataFrame, window_days: int = OBSERVATION_DAYS
) -> DataFrame:
    return with_churn_label(summary, window_days).select(
        "customer_unique_id",
        "total_orders",
        "last_order_at",
        "max_order_date",
        "days_since_last_order",
        "has_sufficient_window",
        "churned",
    )


def order_buyers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The person behind each delivered order: order_id, customer_unique_id."""
    return (
        delivered(orders)
        .select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select("order_id", "customer_unique_id")
    )


def product_features(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Distinct categories and products per person; items of unknown products do not count."""
    return (
        items.select("order_id", "product_id")
        .join(order_buyers(orders, customers), "order_id")
        .join(products.select("product_id", "product_category"), "product_id")
        .groupBy("customer_unique_id")
        .agg(
            F.countDistinct("product_category").alias("unique_categories_purchased"),
            F.countDistinct("product_id").alias("unique_products_purchased"),
        )
    )


def payment_ratios(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment methods per person and the shares paid by card and by boleto.
    Payments are counted per person and method first, so a busy person reaches the last step as
    one row per method.
    """
    uses = (
        payments.select("order_id", "payment_type")
        .join(order_buyers(orders, customers), "order_id")
        .groupBy("customer_unique_id", "payment_type")
        .agg(F.count("*").alias("uses"))
    )

    def share(method: str) -> Column:
        used = F.sum(F.when(F.col("payment_type") == method, F.col("uses")).otherwise(0))
        return ratio(used, F.sum("uses"))

    return uses.groupBy("customer_unique_id").agg(
        F.count("payment_type").alias("unique_payment_methods"),
        share("credit_card").alias("credit_card_usage_ratio"),
        share("boleto").alias("boleto_usage_ratio"),
    )


def customer_behavioral_features(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """Product variety and payment habits of every person who bought a known product."""
    return (
        product_features(items, orders, customers, products)
        .join(payment_ratios(payments, orders, customers), "customer_unique_id", "left")
        .select(
            "customer_unique_id",
            "unique_categories_purchased",
            "unique_products_purchased",
            "unique_payment_methods",
            "credit_card_usage_ratio",
            "boleto_usage_ratio",
        )
    )


def customer_360(
    scored: DataFrame, behavioral: DataFrame, window_days: int = OBSERVATION_DAYS
) -> DataFrame:
    """The wide customer table: summary, scores, behaviour and label of each labelled person.

    ``scored`` is the summary with its scores (``with_rfm``). Scores and labels are functions of
    a summary row and a few constants, so they are added in place rather than joined back; the
    behavioural features are the only join.
    """
    labelled = with_churn_label(scored, window_days)
    return (
        labelled.filter(F.col("customer_unique_id").isNotNull())
        .join(behavioral, "customer_unique_id", "left")
        .select(
            "customer_unique_id",
            "state",
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
            day_diff("first_order_at", "last_order_at").alias("customer_tenure_days"),
            "recency_days",
            "frequency",
            "monetary",
            "recency_score",
            "frequency_score",
            "monetary_score",
            "rfm_combined_score",
            "unique_categories_purchased",
            "unique_products_purchased",
            "unique_payment_methods",
            "credit_card_usage_ratio",
            "boleto_usage_ratio",
            "days_since_last_order",
            "churned",
        )
    )
