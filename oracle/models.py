"""Common table expressions for every model, written against the benchmark tables."""

from __future__ import annotations

import re


def dec(x: str) -> str:
    # Spark rounds the shortest decimal text of a double; so does a cast by way of text.
    return f"cast(cast({x} as varchar) as decimal(18,6))"


def tot(x: str) -> str:
    return f"cast(sum({dec(x)}) as double)"


def avg(x: str) -> str:
    return f"(cast(sum({dec(x)}) as double) / nullif(count({x}), 0))"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def days(a: str, b: str) -> str:
    return f"cast(date_diff('day', {a}, {b}) as int)"


CTES = {
    # raw shape and staging in one step
    "stg_customers": """
        select cast(o_orderkey as varchar) customer_id, cast(o_custkey as varchar) customer_unique_id,
               cast(c_nationkey as varchar) zip_code, c_mktsegment city, n_name state
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "stg_orders": """
        select cast(o_orderkey as varchar) order_id, cast(o_orderkey as varchar) customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                    when 'P' then 'processing' end order_status,
               o_orderdate + to_hours(o_orderkey % 24) purchased_at,
               o_orderdate + to_hours(o_orderkey % 24 + 1) approved_at,
               o_orderdate + to_hours(o_orderkey % 24 + 1 + o_orderkey % 5) shipped_at,
               case when o_orderkey % 97 <> 0 then o_orderdate
                    + to_hours(o_orderkey % 24 + 24 * (1 + o_orderkey % 20) + o_orderkey % 7)
               end delivered_at,
               o_orderdate + to_days(14) estimated_delivery_at
        from orders""",
    "stg_order_items": """
        select cast(l_orderkey as varchar) order_id, l_linenumber order_item_id,
               cast(l_partkey as varchar) product_id, cast(l_suppkey as varchar) seller_id,
               l_shipdate shipping_limit_at, l_extendedprice price,
               l_extendedprice * l_tax freight_value
        from lineitem""",
    "stg_order_payments": """
        select cast(l_orderkey as varchar) order_id, l_linenumber payment_sequential,
               case l_returnflag when 'R' then 'credit_card' when 'A' then 'boleto'
                    when 'N' then 'voucher' end payment_type,
               cast(l_quantity as int) % 10 + 1 payment_installments,
               l_extendedprice * (1 - l_discount) payment_value
        from lineitem""",
    "stg_order_reviews": """
        select concat_ws('-', l_orderkey, l_linenumber) review_id,
               cast(l_orderkey as varchar) order_id,
               case when l_orderkey % 4 <> 0 then cast(l_quantity as int) % 5 + 1 end review_score,
               l_returnflag || l_linestatus review_comment_title,
               case when l_linenumber % 3 <> 0
                    then 'said "' || l_linestatus || '", part ' || l_partkey
               end review_comment_message,
               l_shipdate review_created_at, l_shipdate + to_days(1) review_answered_at
        from lineitem""",
    "stg_products": """
        select cast(p_partkey as varchar) product_id,
               case when p_partkey % 50 <> 0 then
                    case p_type when 'ECONOMY' then 'health_beauty'
                         when 'LARGE' then 'computers_accessories' when 'MEDIUM' then 'auto'
                         when 'PROMO' then 'bed_bath_table' when 'STANDARD' then 'furniture_decor'
                         when 'SMALL' then 'pc_gamer' end
               end product_category,
               cast(length(p_name) as int) product_name_length,
               cast(length(p_name) * 10 as int) product_description_length,
               cast(p_size % 6 + 1 as int) product_photos_count,
               cast(p_size * 100 as int) product_weight_grams,
               cast(p_size + 10 as int) product_length_cm, cast(p_size + 5 as int) product_height_cm,
               cast(p_size + 8 as int) product_width_cm
        from part""",
    "stg_sellers": """
        select cast(s_suppkey as varchar) seller_id, cast(s_nationkey as varchar) zip_code,
               n_name city, r_name state
        from supplier join nation on s_nationkey = n_nationkey
             join region on n_regionkey = r_regionkey""",
    "stg_geolocation": f"""
        select lpad(cast(c_custkey % 200 as varchar), 5, '0') zip_code,
               {avg('(-c_acctbal / 1000)')} latitude, {avg('(c_acctbal / 500)')} longitude,
               max(c_mktsegment) city, max(n_name) state
        from customer join nation on c_nationkey = n_nationkey group by all""",
    "per_order_items": f"""
        select order_id, count(*) item_count, count(distinct product_id) unique_products,
               count(distinct seller_id) unique_sellers, {tot('price')} total_price,
               {tot('freight_value')} total_freight
        from stg_order_items group by order_id""",
    "per_order_payments": f"""
        select order_id, count(distinct payment_type) payment_type_count,
               max(payment_installments) max_installments, {tot('payment_value')} total_payment
        from stg_order_payments group by order_id""",
    "per_order_reviews": f"""
        select order_id, {avg('review_score')} avg_review_score, min(review_score) min_review_score
        from stg_order_reviews group by order_id""",
    "order_enriched": f"""
        select order_id, customer_id, purchased_at, approved_at, shipped_at, delivered_at,
               estimated_delivery_at,
               {days('purchased_at', 'delivered_at')} delivery_days,
               {days('purchased_at', 'estimated_delivery_at')} estimated_delivery_days,
               {days('delivered_at', 'estimated_delivery_at')} delivery_delta_days,
               item_count, unique_products, unique_sellers, total_price, total_freight,
               payment_type_count, max_installments, total_payment, avg_review_score,
               min_review_score
        from stg_orders left join per_order_items using (order_id)
             left join per_order_payments using (order_id)
             left join per_order_reviews using (order_id)
        where order_status = 'delivered'""",
    "customer_order_summary": f"""
        select customer_unique_id, min(city) city, min(state) state,
               count(distinct order_id) total_orders, min(purchased_at) first_order_at,
               max(purchased_at) last_order_at, {tot('total_payment')} lifetime_revenue,
               {avg('total_payment')} avg_order_value, {big('sum(item_count)')} total_items_purchased,
               {avg('delivery_days')} avg_delivery_days,
               {avg('delivery_delta_days')} avg_delivery_delta_days,
               {avg('avg_review_score')} avg_review_score, min(min_review_score) worst_review_score,
               {avg('max_installments')} avg_installments,
               count(*) filter (where delivery_delta_days < 0) late_delivery_count
        from stg_customers join order_enriched using (customer_id) group by customer_unique_id""",
    "boundary": "select max(last_order_at) max_order_date from customer_order_summary",
    "customer_rfm": f"""
        with measured as (
            select customer_unique_id, {days('last_order_at', 'max_order_date')} recency_days,
                   total_orders frequency, lifetime_revenue monetary
            from customer_order_summary, boundary),
        scored as (
            select *,
                cast(ntile(5) over (order by recency_days desc nulls first, customer_unique_id) as int) recency_score,
                cast(ntile(5) over (order by frequency nulls last, customer_unique_id) as int) frequency_score,
                cast(ntile(5) over (order by monetary nulls last, customer_unique_id) as int) monetary_score
            from measured)
        select *, recency_score + frequency_score + monetary_score rfm_combined_score from scored""",
    "customer_churn_labels": f"""
        select customer_unique_id, total_orders, last_order_at, max_order_date,
               {days('last_order_at', 'max_order_date')} days_since_last_order,
               true has_sufficient_window, cast(total_orders = 1 as int) churned
        from customer_order_summary, boundary
        where {days('last_order_at', 'max_order_date')} >= 90""",
    "product_features": """
        select customer_unique_id, count(distinct product_category) unique_categories_purchased,
               count(distinct product_id) unique_products_purchased
        from stg_order_items join stg_orders using (order_id) join stg_customers using (customer_id)
             join stg_products using (product_id)
        where order_status = 'delivered' group by customer_unique_id""",
    "payment_ratios": """
        select customer_unique_id, count(distinct payment_type) unique_payment_methods,
               cast(count(*) filter (where payment_type = 'credit_card') as double) / count(*)
                   credit_card_usage_ratio,
               cast(count(*) filter (where payment_type = 'boleto') as double) / count(*)
                   boleto_usage_ratio
        from stg_order_payments join stg_orders using (order_id)
             join stg_customers using (customer_id)
        where order_status = 'delivered' group by customer_unique_id""",
    "customer_behavioral_features": """
        select customer_unique_id, unique_categories_purchased, unique_products_purchased,
               unique_payment_methods, credit_card_usage_ratio, boleto_usage_ratio
        from product_features left join payment_ratios using (customer_unique_id)""",
    "customer_360": f"""
        select customer_unique_id, state, s.total_orders, lifetime_revenue, avg_order_value,
               total_items_purchased, avg_delivery_days, avg_delivery_delta_days, avg_review_score,
               worst_review_score, avg_installments, late_delivery_count,
               {days('first_order_at', 's.last_order_at')} customer_tenure_days,
               recency_days, frequency, monetary, recency_score, frequency_score, monetary_score,
               rfm_combined_score, unique_categories_purchased, unique_products_purchased,
               unique_payment_methods, credit_card_usage_ratio, boleto_usage_ratio,
               days_since_last_order, churned
        from customer_order_summary s join customer_rfm using (customer_unique_id)
             join customer_churn_labels using (customer_unique_id)
             left join customer_behavioral_features using (customer_unique_id)""",
    "seller_performance": f"""
        select seller_id, city seller_city, state seller_state,
               count(distinct order_id) total_orders_fulfilled,
               count(distinct product_id) unique_products_sold, {tot('price')} total_revenue,
               {avg('price')} avg_item_price, {avg('freight_value')} avg_freight_value,
               {avg('review_score')} avg_review_score, {avg('wait')} avg_delivery_days,
               cast(sum(late) as double) / count(distinct order_id) late_delivery_rate
        from (select s.seller_id, s.city, s.state, i.order_id, i.product_id, i.price,
                     i.freight_value, r.review_score,
                     {days('o.purchased_at', 'o.delivered_at')} wait,
                     coalesce(cast(o.delivered_at > o.estimated_delivery_at as int), 0) late
              from stg_sellers s join stg_order_items i using (seller_id)
                   join stg_orders o on i.order_id = o.order_id and o.order_status = 'delivered'
                   left join stg_order_reviews r on r.order_id = o.order_id)
        group by seller_id, city, state""",
    # customers scored by a fixed rule instead of a fitted model
    "rule_scored": """
        select customer_unique_id, state, total_orders, lifetime_revenue, avg_review_score,
               recency_days, rfm_combined_score, p churn_probability, cast(p > 0.5 as int) churn_prediction,
               case when p <= 0.3 then 'Low' when p <= 0.6 then 'Medium' when p <= 0.8 then 'High'
                    else 'Critical' end churn_risk_tier, churned
        from (select *, cast((cast(customer_unique_id as bigint) * 37) % 101 as double) / 100 p
              from customer_360)""",
    # what a perfect learner of the label rule says: one order, and nothing else, means churn
    "label_scored": """
        select *, cast(total_orders = 1 as int) churn_prediction,
               case when total_orders = 1 then 'Critical' else 'Low' end churn_risk_tier
        from customer_360""",
    # 200 rounds of boosting of a rule that each tree splits on exactly: margins m of the one class and -m
    # of the other start at 1 and grow by a tenth of the gradient of the logistic loss
    "boosted": """
        select 1 / (1 + exp(-2 * m)) p from (
            select list_reduce(list_prepend(1.0::double, range(199)),
                               lambda m, k: m + 0.1::double * 4 / (1 + exp(2 * m))) m)""",
    "fit_scored": """
        select customer_unique_id, state, total_orders, lifetime_revenue, avg_review_score,
               recency_days, rfm_combined_score,
               round(case when churn_prediction = 1 then p else 1 - p end, 9) churn_probability,
               churn_prediction, churn_risk_tier, churned
        from label_scored, boosted""",
    "churn_segment_summary": f"""
        select churn_risk_tier, state, count(*) customer_count,
               count(*) filter (where churned = 1) actual_churned_count,
               {avg('churn_probability')} avg_churn_probability,
               {avg('lifetime_revenue')} avg_lifetime_revenue,
               {avg('total_orders')} avg_total_orders, {avg('avg_review_score')} avg_review_score,
               {avg('recency_days')} avg_recency_days,
               {tot('lifetime_revenue')} total_revenue_at_risk
        from rule_scored group by churn_risk_tier, state""",
}


def using(query: str) -> str:
    """The query with the expressions it needs, in order of definition, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(query)
    if not needed:
        return query
    heads = ",\n".join(f"{name} as ({CTES[name]})" for name in CTES if name in needed)
    if query.lstrip().startswith("with "):
        return f"with {heads},\n{query.lstrip().removeprefix('with ')}"
    return f"with {heads}\n{query}"
