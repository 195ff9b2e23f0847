"""Summaries of scored customers: segments, headline figures, distributions and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.display import percent, reais, thousands
from tidemark.functions.numbers import mean, ratio, total
from tidemark.functions.risk import TIERS, is_at_risk
from tidemark.operators.order_statistics import beyond, draw, rows_at_ranks

SAMPLE_ROWS = 3000
SAMPLE_SEED = 42


def churn_segment_summary(scored: DataFrame, exact: bool = False) -> DataFrame:
    """Size, churn and value of every tier and state; revenue counts every tier."""
    revenue = F.col("lifetime_revenue")
    return scored.groupBy("churn_risk_tier", "state").agg(
        F.count("*").alias("customer_count"),
        F.sum(F.when(F.col("churned") == 1, 1).otherwise(0)).alias("actual_churned_count"),
        mean(F.col("churn_probability"), exact).alias("avg_churn_probability"),
        mean(revenue, exact).alias("avg_lifetime_revenue"),
        mean(F.col("total_orders"), exact).alias("avg_total_orders"),
        mean(F.col("avg_review_score"), exact).alias("avg_review_score"),
        mean(F.col("recency_days"), exact).alias("avg_recency_days"),
        total(revenue, exact).alias("total_revenue_at_risk"),
    )


def kpi_row(scored: DataFrame, exact: bool = False) -> DataFrame:
    """Headline figures in one row; the share is null when there is no customer."""
    at_risk = is_at_risk(F.col("churn_risk_tier"))
    return scored.agg(
        F.count("*").alias("total_customers"),
        F.count(F.when(F.col("churn_prediction") == 1, 1)).alias("predicted_churned"),
        F.count(F.when(at_risk, 1)).alias("at_risk_customers"),
        F.coalesce(
            total(F.when(at_risk, F.col("lifetime_revenue")), exact), F.lit(0.0)
        ).alias("revenue_at_risk"),
    ).withColumn(
        "predicted_churn_share", ratio(F.col("predicted_churned"), F.col("total_customers"))
    )


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """The headline figures as display text."""
    return kpis.select(
        thousands(F.col("total_customers")).alias("total_customers"),
        thousands(F.col("predicted_churned")).alias("predicted_churned"),
        percent(F.col("predicted_churn_share")).alias("predicted_churn_share"),
        thousands(F.col("at_risk_customers")).alias("at_risk_customers"),
        reais(F.col("revenue_at_risk")).alias("revenue_at_risk"),
    )


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Customers per tier in rising order of risk; a tier nobody is in has a null count."""
    tiers = scored.sparkSession.createDataFrame(
        list(enumerate(TIERS, start=1)), "tier_order int, churn_risk_tier string"
    )
    counts = scored.groupBy("churn_risk_tier").agg(F.count("*").alias("customer_count"))
    return tiers.join(counts, "churn_risk_tier", "left").select(
        "tier_order", "churn_risk_tier", "customer_count"
    ).orderBy("tier_order")


def state_churn(scored: DataFrame, states: int = 10) -> DataFrame:
    """Predicted churn rate of the states with the most customers; unknown states left out."""
    return (
        scored.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            mean(F.col("churn_prediction")).alias("churn_rate"),
            F.count("churn_prediction").alias("customer_count"),
        )
        .orderBy(F.desc("customer_count"), "state")
        .limit(states)
    )


def at_risk_customers(scored: DataFrame) -> DataFrame:
    """High and critical customers, most likely to churn first."""
    return scored.filter(is_at_risk(F.col("churn_risk_tier"))).orderBy(
        F.desc("churn_probability"), "customer_unique_id"
    )


def risk_sample(
    scored: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A repeatable uniform sample of exactly ``min(rows, all)`` customers.

    The row that holds the last place is found first; each row is then compared with it, so no task
    merges the candidates of all others.
    """
    place = [draw("customer_unique_id", seed).alias("place"), F.col("customer_unique_id").alias("id")]
    last = rows_at_ranks(
        scored.select(F.lit(0).alias("all"), *place),
        "all",
        ["place", "id"],
        lambda sizes: {(key, 0): min(rows, size) for key, size in sizes.items() if size and rows},
        "sample-keys",
    )
    if not last:
        return scored.limit(0)
    types = ["string", scored.schema["customer_unique_id"].dataType]
    return scored.filter(~beyond(F.struct(*place), last[0, 0], types))
