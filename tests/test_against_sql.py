"""Every registered query against its SQL on the smallest tables, and the model's properties."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tidemark.operators.segments import churn_segment_summary
from tidemark.plans.analytics import Analytics
from tidemark.plans.churn_model import FEATURES, SCORED_COLUMNS, fit_churn_model
from tidemark.sources.tpch_shape import raw_tables_from_tpch

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

FITTED = {
    "churn_prediction", "churn_scores", "churn_segment_summary", "churn_segment_scores", "kpi_row",
    "kpi_labels", "tier_distribution", "state_churn_top10", "at_risk_customers", "risk_sample",
    "risk_sample_size", "holdout_report", "feature_importance_top10", "importance_by_kind",
    "dq_churn_prediction",
}
OWN_TESTS = set(spark_entry.corpus_queries.QUERIES) if spark_entry.corpus_queries else set()
OWN_TESTS |= {"pipeline"} if spark_entry.corpus_pipeline else set()
COMPARED = sorted(set(spark_entry.oracle_sql()) - FITTED - {"pipeline"})


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        connection.execute(f"create view {table} as select * from '{DATA}/{name}'")
    return connection


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda position: names[position])
    return sorted(tuple(repr(row[position]) for position in order) for row in rows)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, DATA)
    cursor = duck.execute(spark_entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, cursor.fetchall())


def test_every_query_is_compared_or_known_to_depend_on_a_fit():
    registered = set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= registered
    assert registered - set(spark_entry.oracle_sql()) - OWN_TESTS == {"feature_importance_top10"}


def test_entry_has_rows(spark):
    df = spark_entry.entry(spark)
    assert len(df.columns) == 27 and df.count() > 0


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    models = Analytics(spark, raw_tables_from_tpch(spark, DATA), rounds=5)
    folder = str(tmp_path_factory.mktemp("marts"))
    return models, models.build_marts(folder), folder


def test_marts_are_stored_and_consistent(spark, marts):
    models, built, folder = marts
    assert set(built) == set(os.listdir(folder))
    scored = built["churn_prediction"]
    assert tuple(scored.columns) == SCORED_COLUMNS
    assert scored.count() == built["customer_360"].count() == models.customer_churn_labels.count()
    segments = built["churn_segment_summary"]
    assert segments.agg(F.sum("customer_count")).first()[0] == scored.count()
    assert {r[0] for r in scored.select("churn_risk_tier").distinct().collect()} <= {
        "Low", "Medium", "High", "Critical",
    }
    low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low <= high <= 1


def test_scores_keep_missing_values_and_learn_the_label(marts):
    _, built, _ = marts
    scored, wide = built["churn_prediction"], built["customer_360"]
    missing = F.count(F.when(F.col("avg_review_score").isNull(), 1))
    assert scored.agg(missing).first()[0] == wide.agg(missing).first()[0] > 0
    assert scored.filter("churn_prediction <> churned").count() == 0


def test_excluded_features_are_left_out(marts):
    _, built, _ = marts
    model = fit_churn_model(
        built["customer_360"], rounds=2, exclude_features=("total_orders", "frequency")
    )
    assert len(model.features) == len(FEATURES) - 2
    names = [row.feature for row in model.importances().collect()]
    assert len(names) == 10 and "frequency" not in names
    assert churn_segment_summary(model.score(built["customer_360"])).count() > 0
    report = {row["class"]: row for row in model.report().collect()}
    assert report["accuracy"].support == model.held_out.count()


def test_importances_are_sorted(marts):
    models, _, _ = marts
    weights = [row.importance for row in models.churn_model.importances().collect()]
    assert weights == sorted(weights, reverse=True) and weights[0] > 0


def test_trees_as_sql_give_the_same_scores(spark, marts):
    """A model without the features that hold the label, scored by another engine from its SQL text."""
    wide = marts[1]["customer_360"]
    model = fit_churn_model(
        wide, rounds=12, exclude_features=("total_orders", "frequency", "customer_tenure_days")
    )
    sql = model.probability_sql("wide")
    assert sql.count("case when") > 100
    connection = duckdb.connect()
    connection.register("wide", wide.toArrow())
    other = dict(connection.execute(sql).fetchall())
    own = {r["customer_unique_id"]: r["churn_probability"] for r in model.score(wide).collect()}
    assert own.keys() == other.keys() and len(set(own.values())) > 20
    assert all(abs(own[key] - other[key]) < 1e-12 for key in own)
    wide.createOrReplaceTempView("wide")
    assert all(abs(own[r[0]] - r[1]) < 1e-12 for r in spark.sql(sql).collect())


def test_importances_from_the_gains_are_those_of_the_library(marts):
    wide = marts[1]["customer_360"]
    model = fit_churn_model(wide, rounds=6, exclude_features=("total_orders", "frequency"))
    given = model.classifier.featureImportances
    found = {r["feature"]: r["importance"] for r in model.importances(top=18).collect()}
    assert list(found) and len(found) == 18
    assert all(abs(found[n] - float(given[k])) < 1e-12 for k, n in enumerate(model.features))
