"""One SQL text per registered query that SQL can express."""

from __future__ import annotations

from oracle.models import CTES, avg, big, days, dec, tot, using
from tidemark.operators.segments import SAMPLE_ROWS, SAMPLE_SEED
from tidemark.operators.training import SPLIT_SEED
from tidemark.plans.churn_model import FEATURES
from tidemark.plans.metrics import METRICS
from tidemark.plans.quality import CHECKS

SAME_NAME = (
    "stg_customers",
    "stg_orders",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_products",
    "stg_sellers",
    "order_enriched",
    "customer_order_summary",
    "customer_rfm",
    "payment_ratios",
    "customer_behavioral_features",
    "customer_churn_labels",
    "customer_360",
    "seller_performance",
)


def kpis(source: str) -> str:
    risky = "churn_risk_tier in ('High', 'Critical')"
    return f"""
        select count(*) total_customers,
               count(*) filter (where churn_prediction = 1) predicted_churned,
               count(*) filter (where {risky}) at_risk_customers,
               coalesce(cast(sum({dec("lifetime_revenue")}) filter (where {risky})
                   as double), 0.0) revenue_at_risk,
               cast(count(*) filter (where churn_prediction = 1) as double) / nullif(count(*), 0)
                   predicted_churn_share
        from {source}"""


def tiers(source: str) -> str:
    return f"""
        select tier_order, t.churn_risk_tier, customer_count
        from (values (1, 'Low'), (2, 'Medium'), (3, 'High'), (4, 'Critical'))
             t(tier_order, churn_risk_tier)
        left join (select churn_risk_tier, count(*) customer_count from {source} group by all) c
             on c.churn_risk_tier = t.churn_risk_tier
        order by tier_order"""


def state_rates(source: str) -> str:
    return f"""
        select state, avg(churn_prediction) churn_rate, count(churn_prediction) customer_count
        from {source} where state is not null group by state
        order by customer_count desc, state limit 10"""


def report() -> str:
    return """
        with per_class as (
            select k, cast(count(*) filter (where churned = k) as bigint) support,
                   count(*) filter (where churn_prediction = k) named,
                   count(*) filter (where churned = k and churn_prediction = k) hits
            from rule_scored, (values (0), (1)) c(k) group by k),
        measured as (
            select k, support, hits, coalesce(hits / nullif(cast(named as double), 0), 0) p,
                   coalesce(hits / nullif(cast(support as double), 0), 0) r,
                   coalesce(2 * hits / nullif(cast(named + support as double), 0), 0) f
            from per_class)
        select cast(k as varchar) as "class", p "precision", r recall, f f1_score, support from measured
        union all
        select 'accuracy', null, null, cast(sum(hits) as double) / sum(support),
               cast(sum(support) as bigint) from measured
        union all
        select 'macro avg', avg(p), avg(r), avg(f), cast(sum(support) as bigint) from measured
        union all
        select 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
               sum(f * support) / sum(support), cast(sum(support) as bigint) from measured"""


def split_counts() -> str:
    """Largest-remainder shares of the training rows; the rest of each class is held out."""
    return """
        with sizes as (select churned, count(*) n from customer_360 group by churned),
        whole as (select sum(n) rows, sum(n) - ceil(0.2 * sum(n)) training from sizes),
        quota as (select churned, n, training * n / rows q, floor(training * n / rows) kept, training
                  from sizes, whole),
        ranked as (select *, row_number() over (order by q - kept desc, churned) place,
                          training - sum(kept) over () spare from quota),
        final as (select churned, n, cast(kept + case when place <= spare then 1 else 0 end as bigint) train
                  from ranked)
        select churned, false held_out, train n from final
        union all select churned, true, n - train from final"""


def medians() -> str:
    filled = ", ".join(
        f"coalesce(cast({name} as double), median({name}) over ()) {name}" for name in FEATURES
    )
    return f"select customer_unique_id, {filled} from customer_360"


def check_sql(check) -> str:
    column, model = check.column, check.model
    if check.kind == "unique":
        body = f"""select count(*) from (select {column} from {model}
                   where {column} is not null group by {column} having count(*) > 1)"""
    elif check.kind == "not_null":
        body = f"select count(*) from {model} where {column} is null"
    elif check.kind == "accepted_values":
        listed = ", ".join(repr(value) for value in check.accepted)
        body = f"""select count(distinct {column}) from {model}
                   where {column} not in ({listed})"""
    else:
        parent, parent_column = check.parent
        body = f"""select count(*) from {model} where {column} is not null and not exists
                   (select 1 from {parent} where {parent}.{parent_column} = {model}.{column})"""
    return (
        f"""select '{model}' model, '{column}' as "column", '{check.kind}' as "check", """
        f"({body}) failures"
    )


def unlabelled(window: int) -> str:
    observed = days("last_order_at", "max_order_date")
    return f"""
        select customer_unique_id from customer_order_summary, boundary
        where {observed} >= 90 and not {observed} >= {window}"""


def metric_sql(
    model: str, source: str, names=None, by: str = "", where: str = "", by_text: bool = False
) -> str:
    """``by_text`` rounds the shortest decimal text of a value, as Spark does; it matters for ties."""
    measures = []
    for metric in METRICS:
        if metric.model != model or (names and metric.name not in names):
            continue
        value = {
            "count": f"count({metric.column})",
            "average": avg(metric.column),
            "sum": tot(metric.column),
        }[metric.aggregate]
        if metric.aggregate == "sum" and metric.column in WHOLE_NUMBERS:
            value = big(f"sum({metric.column})")
        if metric.digits is not None and by_text:
            text = f"cast(cast({value} as varchar) as decimal(38,17))"
            value = f"cast(round({text}, {metric.digits}) as double)"
        elif metric.digits is not None:
            value = f"round({value}, {metric.digits})"
        measures.append(f"{value} {metric.name}")
    head = f"{by}, " if by else ""
    group = f" group by {by}" if by else ""
    condition = f" where {where}" if where else ""
    return f"select {head}{', '.join(measures)} from {source}{condition}{group}"


WHOLE_NUMBERS = {
    "item_count",
    "total_orders",
    "total_items_purchased",
    "late_delivery_count",
    "frequency",
    "churned",
    "churn_prediction",
    "customer_count",
    "actual_churned_count",
    "total_orders_fulfilled",
}
METRIC_SOURCES = {
    **{metric.model: metric.model for metric in METRICS},
    "churn_prediction": "rule_scored",
}


def texts() -> dict[str, str]:
    sql = {name: f"select * from {name}" for name in SAME_NAME}
    sql["geolocation_by_zip"] = "select * from stg_geolocation"
    sql["order_items_agg"] = "select * from per_order_items"
    sql["order_payments_agg"] = "select * from per_order_payments"
    sql["order_reviews_agg"] = "select * from per_order_reviews"
    sql["dataset_boundary"] = "select * from boundary"
    sql["ntile_monetary_nulls"] = """
        select customer_unique_id, monetary, monetary_score from customer_rfm where monetary is null"""
    sql["median_impute"] = medians()
    sql["stratified_split_counts"] = split_counts()
    sql["classification_report"] = report()
    sql["risk_tier_edges"] = """
        select order_id, p, case when p <= 0.3 then 'Low' when p <= 0.6 then 'Medium'
               when p <= 0.8 then 'High' else 'Critical' end churn_risk_tier
        from (select order_id, cast(cast(order_id as bigint) % 101 as double) / 100 p
              from stg_orders)"""

    sql["churn_prediction"] = """
        select customer_unique_id, state, total_orders, lifetime_revenue, avg_review_score,
               recency_days, rfm_combined_score, churn_prediction, churn_risk_tier, churned
        from label_scored"""
    sql["churn_scores"] = "select * from fit_scored"
    sql["churn_segment_scores"] = CTES["churn_segment_summary"].replace("rule_scored", "fit_scored")
    # one order, its copy, and no time between first and last order say the same: trees take either
    sql["importance_by_kind"] = """
        select * from (values ('holds the label', 3::bigint, 1.0::double), ('other', 17, 0.0))
            t(kind, features, importance)"""
    sql["kpi_row"] = kpis("label_scored")
    sql["kpi_labels"] = f"""
        select format('{{:,}}', total_customers) total_customers,
               format('{{:,}}', predicted_churned) predicted_churned,
               cast(round_even(predicted_churn_share * 100, 0) as int) || '%' predicted_churn_share,
               format('{{:,}}', at_risk_customers) at_risk_customers,
               'R$' || format('{{:,}}', cast(round_even(revenue_at_risk, 0) as bigint)) revenue_at_risk
        from ({kpis("label_scored")})"""
    sql["risk_sample"] = f"""
        select * from ({sql["churn_prediction"]})
        order by md5(customer_unique_id || '-{SAMPLE_SEED}'), customer_unique_id
        limit {SAMPLE_ROWS}"""
    sql["stratified_split_rows"] = f"""
        with held as (select churned, n from ({split_counts()}) where held_out),
        drawn as (select customer_unique_id, churned, row_number() over (
            partition by churned
            order by md5(customer_unique_id || '-{SPLIT_SEED}'), customer_unique_id) place
            from customer_360)
        select customer_unique_id, d.churned, place <= coalesce(n, 0) held_out
        from drawn d left join held on held.churned is not distinct from d.churned"""
    sql["risk_sample_size"] = """
        select least(3000, count(*)) rows_drawn, least(3000, count(*)) customers_drawn
        from customer_360"""
    sql["holdout_report"] = f"""
        with held as (select churned, n from ({split_counts()}) where held_out),
        whole as (select cast(sum(n) as bigint) support from held)
        select cast(churned as varchar) as "class", 1.0::double "precision", 1.0::double recall,
               1.0::double f1_score, n support from held
        union all select 'accuracy', null, null, 1.0::double, support from whole
        union all select 'macro avg', 1.0::double, 1.0::double, 1.0::double, support from whole
        union all select 'weighted avg', 1.0::double, 1.0::double, 1.0::double, support from whole"""
    sql["churn_segment_summary"] = f"""
        select churn_risk_tier, state, count(*) customer_count,
               count(*) filter (where churned = 1) actual_churned_count,
               {avg('lifetime_revenue')} avg_lifetime_revenue,
               {avg('total_orders')} avg_total_orders, {avg('avg_review_score')} avg_review_score,
               {avg('recency_days')} avg_recency_days,
               {tot('lifetime_revenue')} total_revenue_at_risk
        from label_scored group by churn_risk_tier, state"""
    sql["tier_distribution"] = tiers("label_scored")
    sql["state_churn_top10"] = state_rates("label_scored")
    sql["at_risk_customers"] = """
        select customer_unique_id, state, lifetime_revenue, churn_risk_tier
        from label_scored where churn_risk_tier in ('High', 'Critical')"""

    sql["churn_segment_summary_rule"] = "select * from churn_segment_summary"
    sql["kpi_row_rule"] = kpis("rule_scored")
    sql["tier_distribution_rule"] = tiers("rule_scored")
    sql["state_churn_top10_rule"] = state_rates("rule_scored")
    sql["at_risk_customers_rule"] = """
        select * from rule_scored where churn_risk_tier in ('High', 'Critical')"""

    sql["dq_unique"] = """
        select order_id, count(*) n_records from stg_order_reviews where order_id is not null
        group by order_id having count(*) > 1"""
    sql["dq_not_null"] = "select * from stg_orders where delivered_at is null"
    sql["dq_accepted_values"] = """
        select order_status, count(*) n_records from stg_orders
        where order_status not in ('delivered', 'shipped') group by order_status"""
    sql["dq_relationships"] = """
        select order_id, count(*) n_records from stg_orders o where order_id is not null
          and not exists (select 1 from stg_order_items i where i.order_id = o.order_id)
        group by order_id"""
    sql["dq_label_completeness"] = unlabelled(120)
    completeness = f"""
        select 'customer_churn_labels' model, 'customer_unique_id' as "column",
               'label_completeness' as "check", (select count(*) from ({unlabelled(90)})) failures"""
    checks = [check_sql(check) for check in CHECKS if check.model != "churn_prediction"]
    sql["dq_summary"] = " union all ".join([*checks, completeness])
    sql["dq_churn_prediction"] = " union all ".join(
        check_sql(check).replace(f"from {check.model}", "from label_scored")
        for check in CHECKS
        if check.model == "churn_prediction"
    )

    for model, source in METRIC_SOURCES.items():
        sql[f"metrics_{model}"] = metric_sql(model, source)
    sql["metric_churn_rate_by_state"] = metric_sql(
        "customer_360", "customer_360", ("churn_rate", "churned_count"), by="state"
    )
    sql["metric_seller_by_state"] = metric_sql(
        "seller_performance", "seller_performance", by="seller_state"
    )
    sql["metric_late_orders_by_delay"] = metric_sql(
        "order_enriched", "order_enriched", by="delivery_days", where="delivery_delta_days < 0"
    )

    every = metric_sql("churn_prediction", "rule_scored", by="state, churn_risk_tier", by_text=True)
    sql["metrics_by_state_and_tier"] = every.replace(
        "select ", "select grouping_id(state, churn_risk_tier)::bigint dimension_set, ", 1
    ).replace(
        "group by state, churn_risk_tier",
        "group by grouping sets ((state, churn_risk_tier), (state), (churn_risk_tier), ())",
    )

    raw = {
        "customers": "stg_customers",
        "orders": "stg_orders",
        "order_items": "stg_order_items",
        "order_payments": "stg_order_payments",
        "order_reviews": "stg_order_reviews",
        "products": "stg_products",
        "sellers": "stg_sellers",
        "geolocation": "customer",
    }
    sql["row_counts"] = " union all ".join(
        f"select '{table}' table_name, count(*) row_count from {source}"
        for table, source in sorted(raw.items())
    )
    bad = {
        "order_payments": "cast(order_id as bigint) % 89 = 0",
        "orders": "cast(order_id as bigint) % 83 = 0",
        "order_reviews": "cast(order_id as bigint) % 79 = 0",
    }
    sql["csv_load_status"] = " union all ".join(
        f"""select '{table}' table_name,
                   count(*) filter (where not ({bad.get(table, 'false')})) rows_loaded,
                   count(*) filter (where {bad.get(table, 'false')}) rows_rejected
            from {source}"""
        for table, source in sorted(raw.items())
    )
    sql["csv_loaded_payments"] = f"""
        select * from stg_order_payments where not ({bad['order_payments']})"""
    reasons = {
        "orders": "order_status: too long",
        "order_payments": "payment_value: not double",
        "order_reviews": "review_score: not int",
    }
    sql["csv_rejects"] = " union all ".join(
        f"select '{table}' table_name, order_id, '{reason}' reason from {raw[table]} where {bad[table]}"
        for table, reason in reasons.items()
    )
    sql["csv_text_load"] = """
        select * from stg_order_items
        where cast(order_id as bigint) % 71 <> 0 and cast(order_id as bigint) % 73 <> 0"""
    sql["csv_text_rejects"] = """
        select 'malformed line' reason, order_id, cast(order_item_id as varchar) order_item_id
        from stg_order_items
        where cast(order_id as bigint) % 71 = 0 or cast(order_id as bigint) % 73 = 0"""
    sql["csv_loaded_reviews"] = """
        select review_id, order_id, review_score, review_comment_title,
               'said "ok",' || chr(10) || 'then ' || order_id review_comment_message,
               review_created_at review_creation_date, review_answered_at review_answer_timestamp
        from stg_order_reviews where cast(order_id as bigint) % 79 <> 0"""
    sql["csv_review_blocks"] = """
        select review_id, order_id, review_score, 'a "title"' review_comment_title,
               'first' || chr(10) || 'second, ' || order_id || chr(10) || 'third' review_comment_message,
               review_created_at review_creation_date, review_answered_at review_answer_timestamp
        from stg_order_reviews where cast(order_id as bigint) % 97 <> 0"""
    sql["csv_mixed_headers"] = """
        select order_id, payment_sequential, payment_value,
               case when cast(order_id as bigint) % 2 = 1 then 'second' end batch
        from stg_order_payments"""
    sql["csv_reload"] = sql["csv_loaded_payments"]
    sql["mart_roundtrip"] = "select * from customer_360"
    sql["mart_replace_after_failure"] = "select * from customer_360"
    sql["metric_revenue_label_by_tier"] = f"""
        select churn_risk_tier, 'R$' || format('{{:,}}', cast(round_even(total, 0) as bigint))
               total_lifetime_revenue
        from (select churn_risk_tier, {tot('lifetime_revenue')} total from rule_scored group by all)"""
    return {name: using(text) for name, text in sql.items()}
