"""Data checks: each is a query for failing rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_diff
from tidemark.functions.risk import TIERS
from tidemark.operators.customers import OBSERVATION_DAYS, dataset_boundary


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """``unique``: values held by more than one row; nulls pass."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    """``not_null``: rows without a value."""
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """``accepted_values``: values outside the list with their rows; nulls pass."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``relationships``: keys the parent lacks with their rows; null keys pass.

    Keys are counted on one side and made distinct on the other before the anti join, so a key held
    by many rows crosses it once.
    """
    keys = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    known = known.distinct()
    return keys.join(known, column, "left_anti")


def unlabelled_customers(
    summary: DataFrame, labels: DataFrame, window_days: int = OBSERVATION_DAYS
) -> DataFrame:
    """Persons observed long enough who have no churn label."""
    observed = day_diff("last_order_at", dataset_boundary(summary).scalar())
    return (
        summary.filter(observed >= window_days)
        .select("customer_unique_id")
        .join(labels.select("customer_unique_id"), "customer_unique_id", "left_anti")
    )


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # unique, not_null, accepted_values or relationships
    accepted: tuple = ()
    parent: tuple[str, str] | None = None


# Allowed values of the checked columns.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)
QUINTILES = (1, 2, 3, 4, 5)
CLASSES = (0, 1)

# The declared checks.
CHECKS = (
    Check("stg_customers", "customer_id", "unique"),
    Check("stg_customers", "customer_id", "not_null"),
    Check("stg_customers", "customer_unique_id", "not_null"),
    Check("stg_geolocation", "zip_code", "unique"),
    Check("stg_geolocation", "zip_code", "not_null"),
    Check("stg_order_items", "order_id", "not_null"),
    Check("stg_order_items", "product_id", "not_null"),
    Check("stg_order_items", "price", "not_null"),
    Check("stg_order_payments", "order_id", "not_null"),
    Check("stg_order_payments", "payment_type", "accepted_values", PAYMENT_TYPES),
    Check("stg_order_payments", "payment_value", "not_null"),
    Check("stg_order_reviews", "review_id", "not_null"),
    Check("stg_order_reviews", "order_id", "not_null"),
    Check("stg_order_reviews", "review_score", "not_null"),
    Check("stg_order_reviews", "review_score", "accepted_values", REVIEW_SCORES),
    Check("stg_orders", "order_id", "unique"),
    Check("stg_orders", "order_id", "not_null"),
    Check("stg_orders", "customer_id", "not_null"),
    Check("stg_orders", "customer_id", "relationships", parent=("stg_customers", "customer_id")),
    Check("stg_orders", "order_status", "accepted_values", ORDER_STATUSES),
    Check("stg_products", "product_id", "unique"),
    Check("stg_products", "product_id", "not_null"),
    Check("stg_sellers", "seller_id", "unique"),
    Check("stg_sellers", "seller_id", "not_null"),
    Check("customer_behavioral_features", "customer_unique_id", "unique"),
    Check("customer_behavioral_features", "customer_unique_id", "not_null"),
    Check("customer_churn_labels", "customer_unique_id", "unique"),
    Check("customer_churn_labels", "customer_unique_id", "not_null"),
    Check("customer_churn_labels", "churned", "accepted_values", CLASSES),
    Check("customer_order_summary", "customer_unique_id", "unique"),
    Check("customer_order_summary", "customer_unique_id", "not_null"),
    Check("customer_order_summary", "total_orders", "not_null"),
    Check("customer_rfm", "customer_unique_id", "unique"),
    Check("customer_rfm", "customer_unique_id", "not_null"),
    Check("customer_rfm", "recency_score", "accepted_values", QUINTILES),
    Check("customer_rfm", "frequency_score", "accepted_values", QUINTILES),
    Check("customer_rfm", "monetary_score", "accepted_values", QUINTILES),
    Check("order_enriched", "order_id", "unique"),
    Check("order_enriched", "order_id", "not_null"),
    Check("order_enriched", "customer_id", "not_null"),
    Check("churn_prediction", "customer_unique_id", "unique"),
    Check("churn_prediction", "customer_unique_id", "not_null"),
    Check("churn_prediction", "churn_prediction", "accepted_values", CLASSES),
    Check("churn_prediction", "churn_risk_tier", "accepted_values", TIERS),
    Check("customer_360", "customer_unique_id", "unique"),
    Check("customer_360", "customer_unique_id", "not_null"),
    Check("customer_360", "churned", "not_null"),
    Check("customer_360", "churned", "accepted_values", CLASSES),
    Check("seller_performance", "seller_id", "unique"),
    Check("seller_performance", "seller_id", "not_null"),
)


def checked_columns(model: str, checks: Sequence[Check] = CHECKS) -> list[str]:
    """The columns of a model that its own checks or those of its children read."""
    own = [check.column for check in checks if check.model == model]
    asked = [check.parent[1] for check in checks if check.parent and check.parent[0] == model]
    return list(dict.fromkeys(own + asked))


def failing_rows(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    """The rows one check returns; an empty frame means it passed."""
    df = models[check.model]
    if check.kind == "unique":
        return duplicated_values(df, check.column)
    if check.kind == "not_null":
        return missing_rows(df, check.column)
    if check.kind == "accepted_values":
        return unaccepted_values(df, check.column, check.accepted)
    if check.kind == "relationships":
        parent, parent_column = check.parent
        return orphan_keys(df, check.column, models[parent], parent_column)
    raise ValueError(f"unknown check: {check.kind}")


def run_checks(models: dict[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """(model, column, check, failures) for every check on the given models.

    ``failures`` counts missing rows, orphan rows, duplicated values or distinct unaccepted
    values. All missing-value and accepted-value checks of a model share one scan of it.
    """
    results = []
    for model, df in models.items():
        mine = [check for check in checks if check.model == model]
        scanned = [check for check in mine if check.kind in ("not_null", "accepted_values")]
        if scanned:
            results.append(_scan(df, scanned))
        for check in mine:
            if check not in scanned:
                results.append(_count(check, models))
    summary = results[0]
    for result in results[1:]:
        summary = summary.unionByName(result)
    return summary


def _scan(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = []
    for check in checks:
        value = F.col(check.column)
        if check.kind == "not_null":
            counts.append(F.count(F.when(value.isNull(), 1)))
        else:
            counts.append(F.countDistinct(F.when(~value.isin(*check.accepted), value)))
    one = df.agg(*[count.alias(f"c{position}") for position, count in enumerate(counts)])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check.model).alias("model"),
                        F.lit(check.column).alias("column"),
                        F.lit(check.kind).alias("check"),
                        F.col(f"c{position}").alias("failures"),
                    )
                    for position, check in enumerate(checks)
                ]
            )
        )
    )


def _count(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    failures = F.count("*")
    if check.kind == "relationships":
        failures = F.coalesce(F.sum("n_records"), F.lit(0).cast("long"))
    return failing_rows(check, models).agg(failures.alias("failures")).select(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"),
        "failures",
    )


def label_completeness(summary: DataFrame, labels: DataFrame) -> DataFrame:
    """The cross-model check in the form of ``run_checks``."""
    return unlabelled_customers(summary, labels).agg(F.count("*").alias("failures")).select(
        F.lit("customer_churn_labels").alias("model"),
        F.lit("customer_unique_id").alias("column"),
        F.lit("label_completeness").alias("check"),
        "failures",
    )
