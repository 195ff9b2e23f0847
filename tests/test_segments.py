from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.shop import by
from tidemark.operators import segments

SCHEMA = (
    "customer_unique_id string, state string, total_orders long, lifetime_revenue double, "
    "avg_review_score double, recency_days int, rfm_combined_score int, churn_probability double, "
    "churn_prediction int, churn_risk_tier string, churned int"
)


def scored(spark, rows):
    return spark.createDataFrame(
        [
            (name, state, 1, revenue, 4.0, 100, 9, p, int(p > 0.5), tier, int(p > 0.5))
            for name, state, revenue, p, tier in rows
        ],
        SCHEMA,
    )


ROWS = [
    ("a", "SP", 100.0, 0.1, "Low"),
    ("b", "SP", 50.0, 0.7, "High"),
    ("c", "RJ", None, 0.9, "Critical"),
    ("d", None, 30.0, 0.9, "Critical"),
]


def test_segments_keep_unknown_states_and_count_all_revenue(spark):
    rows = segments.churn_segment_summary(scored(spark, ROWS)).collect()
    assert len(rows) == 4
    assert sum(r.customer_count for r in rows) == 4
    assert sum(r.total_revenue_at_risk or 0 for r in rows) == 180.0
    unknown = [r for r in rows if r.state is None]
    assert len(unknown) == 1 and unknown[0].actual_churned_count == 1


def test_kpis(spark):
    row = segments.kpi_row(scored(spark, ROWS)).first()
    assert tuple(row) == (4, 3, 3, 80.0, 0.75)
    text = segments.kpi_labels(segments.kpi_row(scored(spark, ROWS))).first()
    assert tuple(text) == ("4", "3", "75%", "3", "R$80")


def test_kpis_of_nothing_and_of_no_risk(spark):
    row = segments.kpi_row(scored(spark, [])).first()
    assert tuple(row) == (0, 0, 0, 0.0, None)
    assert segments.kpi_row(scored(spark, ROWS[:1])).first().revenue_at_risk == 0.0


def test_every_tier_is_listed(spark):
    rows = segments.tier_distribution(scored(spark, ROWS)).collect()
    assert [(r.churn_risk_tier, r.customer_count) for r in rows] == [
        ("Low", 1), ("Medium", None), ("High", 1), ("Critical", 2),
    ]


def test_state_rates_rank_by_customers(spark):
    rows = segments.state_churn(scored(spark, ROWS)).collect()
    assert [tuple(r) for r in rows] == [("SP", 0.5, 2), ("RJ", 1.0, 1)]
    assert [r.state for r in segments.state_churn(scored(spark, ROWS), 1).collect()] == ["SP"]


def test_at_risk_list_is_sorted(spark):
    rows = segments.at_risk_customers(scored(spark, ROWS)).collect()
    assert [r.customer_unique_id for r in rows] == ["c", "d", "b"]


def test_sample_is_exact_and_repeatable(spark):
    many = spark.range(500).select(F.col("id").cast("string").alias("customer_unique_id"))
    one = by(segments.risk_sample(many, rows=120), "customer_unique_id")
    two = by(segments.risk_sample(many.repartition(9), rows=120), "customer_unique_id")
    other = by(segments.risk_sample(many, rows=120, seed=1), "customer_unique_id")
    assert len(one) == 120 and set(one) == set(two) != set(other)
    assert segments.risk_sample(many, rows=3000).count() == 500


def test_exact_and_double_sums_agree(spark):
    a = by(segments.churn_segment_summary(scored(spark, ROWS), True), "state")
    b = by(segments.churn_segment_summary(scored(spark, ROWS), False), "state")
    for state in a:
        for name, value in a[state].asDict().items():
            if isinstance(value, float):
                assert b[state][name] == pytest.approx(value)
