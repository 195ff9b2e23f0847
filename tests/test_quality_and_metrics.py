from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.shop import by
from tidemark.plans import metrics, quality
from tidemark.plans.quality import CHECKS, Check


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [("1", "a", "delivered"), ("1", "b", "lost"), (None, "a", "lost"), (None, None, None),
         ("2", "x", "shipped"), ("3", "x", "gone")],
        "order_id string, customer_id string, order_status string",
    )


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("a",), ("b",), (None,)], "customer_id string")


def test_each_check_reports_violations_and_passes_nulls(orders, people):
    assert {tuple(r) for r in quality.duplicated_values(orders, "order_id").collect()} == {("1", 2)}
    assert quality.missing_rows(orders, "order_id").count() == 2
    bad = quality.unaccepted_values(orders, "order_status", ("delivered", "shipped"))
    assert {tuple(r) for r in bad.collect()} == {("lost", 2), ("gone", 1)}
    orphans = quality.orphan_keys(orders, "customer_id", people, "customer_id")
    assert [tuple(r) for r in orphans.collect()] == [("x", 2)]


def test_summary_counts_failures(orders, people):
    checks = (
        Check("orders", "order_id", "unique"),
        Check("orders", "order_id", "not_null"),
        Check("orders", "order_status", "accepted_values", ("delivered", "shipped")),
        Check("orders", "customer_id", "relationships", parent=("people", "customer_id")),
        Check("people", "customer_id", "unique"),
        Check("people", "customer_id", "not_null"),
    )
    rows = quality.run_checks({"orders": orders, "people": people}, checks).collect()
    got = {(r.model, r.column, r.check): r.failures for r in rows}
    assert got == {
        ("orders", "order_id", "unique"): 1,
        ("orders", "order_id", "not_null"): 2,
        ("orders", "order_status", "accepted_values"): 2,
        ("orders", "customer_id", "relationships"): 2,
        ("people", "customer_id", "unique"): 0,
        ("people", "customer_id", "not_null"): 1,
    }


def test_label_completeness(spark):
    from tests.shop import at

    summary = spark.createDataFrame(
        [("a", at("2020-01-01")), ("b", at("2020-01-02")), ("c", at("2020-12-31"))],
        "customer_unique_id string, last_order_at timestamp_ntz",
    )
    labels = spark.createDataFrame([("a",)], "customer_unique_id string")
    missing = quality.unlabelled_customers(summary, labels)
    assert [r[0] for r in missing.collect()] == ["b"]
    assert quality.label_completeness(summary, labels).first().failures == 1


def test_declared_checks():
    assert Counter(check.kind for check in CHECKS) == {
        "unique": 13, "not_null": 26, "accepted_values": 10, "relationships": 1,
    }


def test_declared_metrics():
    assert len(metrics.METRICS) == 90
    assert Counter(m.aggregate for m in metrics.METRICS) == {"average": 60, "sum": 29, "count": 1}
    assert sum(m.digits is not None for m in metrics.METRICS) == 28
    assert sum(m.text_format is not None for m in metrics.METRICS) == 1
    keys = [(m.model, m.name) for m in metrics.METRICS]
    assert len(set(keys)) == 90


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame(
        [("Low", "SP", 10, 2, 0.1, 5.0, 50.0), ("Low", "RJ", 30, 1, 0.3, 7.005, 10.0),
         ("High", "SP", 5, 5, 0.7777, None, 1.0)],
        "churn_risk_tier string, state string, customer_count long, actual_churned_count long, "
        "avg_churn_probability double, avg_lifetime_revenue double, total_revenue_at_risk double",
    )


def test_averages_of_averages_are_unweighted_and_rounded(segments):
    row = metrics.metric_query("churn_segment_summary", segments).first()
    assert row.total_customers == 45 and row.total_churned == 8
    assert row.weighted_avg_churn_prob == 0.393
    assert row.total_revenue_at_risk_sum == 61.0


def test_dimensions_and_filters(segments):
    rows = by(
        metrics.metric_query(
            "churn_segment_summary", segments, ["total_customers"], ["state"],
            F.col("churn_risk_tier") == "Low",
        ),
        "state",
    )
    assert {state: row.total_customers for state, row in rows.items()} == {"SP": 10, "RJ": 30}


def test_unknown_names_are_refused(segments):
    with pytest.raises(ValueError, match="nope"):
        metrics.metric_query("churn_segment_summary", segments, ["nope"])
    with pytest.raises(ValueError, match="planet"):
        metrics.metric_query("churn_segment_summary", segments, None, ["planet"])


def test_text_formats(spark):
    df = spark.createDataFrame([(1234.5,)], "total_lifetime_revenue double")
    assert metrics.with_text_formats("churn_prediction", df).first()[0] == "R$1,234"


def test_totals_of_several_sets_come_from_one_aggregation(spark):
    from tidemark.plans.metrics import metric_totals

    rows = [("SP", "Low", 10.0), ("SP", "High", 5.0), (None, "Low", 1.0)]
    df = spark.createDataFrame(rows, "state string, churn_risk_tier string, lifetime_revenue double")
    out = metric_totals(
        "churn_prediction", df, (("state",), ("churn_risk_tier",), ()), ("total_lifetime_revenue",)
    )
    found = {(r.state, r.churn_risk_tier, r.dimension_set): r.total_lifetime_revenue for r in out.collect()}
    assert found == {
        ("SP", None, 1): 15.0, (None, None, 1): 1.0, (None, "Low", 2): 11.0, (None, "High", 2): 5.0,
        (None, None, 3): 16.0,
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Expand") == 1
