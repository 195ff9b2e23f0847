"""Declared metrics, evaluated over chosen dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.display import reais
from tidemark.functions.numbers import mean, total


@dataclass(frozen=True)
class Metric:
    """An aggregate of one column over the rows of its model.

    Rows weigh the same, so averaging a column of averages is unweighted.
    """

    model: str
    name: str
    aggregate: str  # sum, average or count
    column: str
    digits: int | None = None
    text_format: str | None = None

    def expression(self, df: DataFrame, exact: bool) -> Column:
        value = F.col(self.column)
        if self.aggregate == "count":
            result = F.count(value)
        elif self.aggregate == "average":
            result = mean(value, exact)
        elif df.schema[self.column].dataType.simpleString() in ("int", "bigint"):
            result = F.sum(value)
        else:
            result = total(value, exact)
        if self.digits is not None:
            result = F.round(result, self.digits)
        return result.alias(self.name)


# The declared metrics.
METRICS = (
    Metric("stg_order_items", "total_price", "sum", "price"),
    Metric("stg_order_items", "average_price", "average", "price"),
    Metric("stg_order_items", "total_freight_value", "sum", "freight_value"),
    Metric("stg_order_items", "average_freight_value", "average", "freight_value"),
    Metric("stg_order_payments", "average_installments", "average", "payment_installments"),
    Metric("stg_order_payments", "total_payment_value", "sum", "payment_value"),
    Metric("stg_order_payments", "average_payment_value", "average", "payment_value"),
    Metric("stg_order_reviews", "average_review_score", "average", "review_score"),
    Metric("stg_order_reviews", "count_reviews", "count", "review_score"),
    Metric("stg_products", "average_weight_grams", "average", "product_weight_grams"),
    Metric("customer_behavioral_features", "avg_unique_categories", "average", "unique_categories_purchased"),
    Metric("customer_behavioral_features", "avg_unique_products", "average", "unique_products_purchased"),
    Metric("customer_behavioral_features", "avg_credit_card_usage_ratio", "average", "credit_card_usage_ratio"),
    Metric("customer_behavioral_features", "avg_boleto_usage_ratio", "average", "boleto_usage_ratio"),
    Metric("customer_churn_labels", "sum_total_orders", "sum", "total_orders"),
    Metric("customer_churn_labels", "avg_days_since_last_order", "average", "days_since_last_order"),
    Metric("customer_churn_labels", "total_churned", "sum", "churned"),
    Metric("customer_churn_labels", "churn_rate", "average", "churned"),
    Metric("customer_order_summary", "sum_total_orders", "sum", "total_orders"),
    Metric("customer_order_summary", "avg_total_orders", "average", "total_orders"),
    Metric("customer_order_summary", "sum_lifetime_revenue", "sum", "lifetime_revenue"),
    Metric("customer_order_summary", "avg_lifetime_revenue", "average", "lifetime_revenue"),
    Metric("customer_order_summary", "overall_avg_order_value", "average", "avg_order_value"),
    Metric("customer_order_summary", "sum_total_items_purchased", "sum", "total_items_purchased"),
    Metric("customer_order_summary", "overall_avg_delivery_days", "average", "avg_delivery_days"),
    Metric("customer_order_summary", "overall_avg_review_score", "average", "avg_review_score"),
    Metric("customer_order_summary", "sum_late_deliveries", "sum", "late_delivery_count"),
    Metric("customer_rfm", "avg_recency_days", "average", "recency_days"),
    Metric("customer_rfm", "sum_frequency", "sum", "frequency"),
    Metric("customer_rfm", "avg_frequency", "average", "frequency"),
    Metric("customer_rfm", "sum_monetary", "sum", "monetary"),
    Metric("customer_rfm", "avg_monetary", "average", "monetary"),
    Metric("customer_rfm", "avg_recency_score", "average", "recency_score"),
    Metric("customer_rfm", "avg_frequency_score", "average", "frequency_score"),
    Metric("customer_rfm", "avg_monetary_score", "average", "monetary_score"),
    Metric("customer_rfm", "avg_rfm_combined_score", "average", "rfm_combined_score"),
    Metric("order_enriched", "avg_delivery_days", "average", "delivery_days"),
    Metric("order_enriched", "avg_delivery_delta_days", "average", "delivery_delta_days"),
    Metric("order_enriched", "total_item_count", "sum", "item_count"),
    Metric("order_enriched", "avg_item_count", "average", "item_count"),
    Metric("order_enriched", "sum_total_price", "sum", "total_price"),
    Metric("order_enriched", "avg_total_price", "average", "total_price"),
    Metric("order_enriched", "sum_total_freight", "sum", "total_freight"),
    Metric("order_enriched", "sum_total_payment", "sum", "total_payment"),
    Metric("order_enriched", "avg_total_payment", "average", "total_payment"),
    Metric("order_enriched", "overall_avg_review_score", "average", "avg_review_score"),
    Metric("churn_prediction", "total_orders_sum", "sum", "total_orders"),
    Metric("churn_prediction", "avg_orders_per_customer", "average", "total_orders"),
    Metric("churn_prediction", "total_lifetime_revenue", "sum", "lifetime_revenue", text_format="brl"),
    Metric("churn_prediction", "avg_lifetime_revenue", "average", "lifetime_revenue"),
    Metric("churn_prediction", "overall_avg_review", "average", "avg_review_score", digits=2),
    Metric("churn_prediction", "avg_recency", "average", "recency_days", digits=0),
    Metric("churn_prediction", "avg_rfm_score", "average", "rfm_combined_score", digits=1),
    Metric("churn_prediction", "avg_churn_probability", "average", "churn_probability", digits=3),
    Metric("churn_prediction", "predicted_churned_count", "sum", "churn_prediction"),
    Metric("churn_prediction", "churn_rate", "average", "churn_prediction", digits=3),
    Metric("churn_prediction", "actual_churned_count", "sum", "churned"),
    Metric("churn_prediction", "actual_churn_rate", "average", "churned", digits=3),
    Metric("churn_segment_summary", "total_customers", "sum", "customer_count"),
    Metric("churn_segment_summary", "total_churned", "sum", "actual_churned_count"),
    Metric("churn_segment_summary", "weighted_avg_churn_prob", "average", "avg_churn_probability", digits=3),
    Metric("churn_segment_summary", "overall_avg_revenue", "average", "avg_lifetime_revenue", digits=2),
    Metric("churn_segment_summary", "total_revenue_at_risk_sum", "sum", "total_revenue_at_risk"),
    Metric("customer_360", "total_orders_sum", "sum", "total_orders"),
    Metric("customer_360", "avg_orders", "average", "total_orders", digits=1),
    Metric("customer_360", "total_revenue", "sum", "lifetime_revenue"),
    Metric("customer_360", "avg_revenue", "average", "lifetime_revenue", digits=2),
    Metric("customer_360", "overall_avg_order_value", "average", "avg_order_value", digits=2),
    Metric("customer_360", "total_items", "sum", "total_items_purchased"),
    Metric("customer_360", "overall_avg_delivery_days", "average", "avg_delivery_days", digits=1),
    Metric("customer_360", "overall_avg_review", "average", "avg_review_score", digits=2),
    Metric("customer_360", "total_late_deliveries", "sum", "late_delivery_count"),
    Metric("customer_360", "avg_tenure", "average", "customer_tenure_days", digits=0),
    Metric("customer_360", "avg_recency", "average", "recency_days", digits=0),
    Metric("customer_360", "avg_rfm", "average", "rfm_combined_score", digits=1),
    Metric("customer_360", "avg_categories", "average", "unique_categories_purchased", digits=1),
    Metric("customer_360", "avg_credit_card_ratio", "average", "credit_card_usage_ratio", digits=3),
    Metric("customer_360", "avg_boleto_ratio", "average", "boleto_usage_ratio", digits=3),
    Metric("customer_360", "churned_count", "sum", "churned"),
    Metric("customer_360", "churn_rate", "average", "churned", digits=3),
    Metric("seller_performance", "total_orders", "sum", "total_orders_fulfilled"),
    Metric("seller_performance", "avg_orders_per_seller", "average", "total_orders_fulfilled", digits=0),
    Metric("seller_performance", "avg_product_catalog_size", "average", "unique_products_sold", digits=0),
    Metric("seller_performance", "total_seller_revenue", "sum", "total_revenue"),
    Metric("seller_performance", "avg_seller_revenue", "average", "total_revenue", digits=2),
    Metric("seller_performance", "overall_avg_price", "average", "avg_item_price", digits=2),
    Metric("seller_performance", "overall_avg_freight", "average", "avg_freight_value", digits=2),
    Metric("seller_performance", "overall_avg_review", "average", "avg_review_score", digits=2),
    Metric("seller_performance", "overall_avg_delivery_days", "average", "avg_delivery_days", digits=1),
    Metric("seller_performance", "overall_late_rate", "average", "late_delivery_rate", digits=3),
)

# Display format by name.
TEXT_FORMATS = {"brl": reais}


def declared(model: str) -> dict[str, Metric]:
    """The metrics of a model by name; names repeat between models."""
    return {metric.name: metric for metric in METRICS if metric.model == model}


def metric_query(
    model: str,
    df: DataFrame,
    metrics: Sequence[str] | None = None,
    dimensions: Sequence[str] = (),
    where: Column | None = None,
    exact: bool = False,
) -> DataFrame:
    """Evaluate metrics of a model (all by default), grouped by any of its columns.

    ``where`` filters the model's rows before they are aggregated. Any column of the model may
    serve as a dimension. One aggregation answers all metrics.
    """
    known = declared(model)
    names = list(known) if metrics is None else list(metrics)
    unknown = [name for name in names if name not in known]
    unknown += [name for name in dimensions if name not in df.columns]
    if unknown:
        raise ValueError(f"{model} has no metric or dimension {', '.join(unknown)}")
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*dimensions).agg(*[known[name].expression(df, exact) for name in names])


def metric_totals(
    model: str,
    df: DataFrame,
    dimension_sets: Sequence[Sequence[str]],
    metrics: Sequence[str] | None = None,
    where: Column | None = None,
    exact: bool = False,
) -> DataFrame:
    """Metrics of a model for several sets of dimensions at once, from one scan and one aggregation.

    All dimensions are columns of the result, null where a row's set does not have them. The number
    ``dimension_set`` tells such a null from one in the data: a bit for each dimension in the order of
    their first mention, the last one lowest, set where the dimension is summed over.
    """
    known = declared(model)
    names = list(known) if metrics is None else list(metrics)
    dimensions = list(dict.fromkeys(name for some in dimension_sets for name in some))
    unknown = [name for name in names if name not in known]
    unknown += [name for name in dimensions if name not in df.columns]
    if unknown:
        raise ValueError(f"{model} has no metric or dimension {', '.join(unknown)}")
    rows = df if where is None else df.filter(where)
    sets = [[F.col(name) for name in some] for some in dimension_sets]
    return rows.groupingSets(sets, *dimensions).agg(
        F.grouping_id(*dimensions).alias("dimension_set"),
        *[known[name].expression(df, exact) for name in names],
    )


def with_text_formats(model: str, result: DataFrame) -> DataFrame:
    """Turn metrics that declare a display format into text."""
    formatted = {
        name: TEXT_FORMATS[metric.text_format](F.col(name))
        for name, metric in declared(model).items()
        if metric.text_format and name in result.columns
    }
    return result.withColumns(formatted) if formatted else result
