from __future__ import annotations

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.quantiles import Score, exact_medians, with_ntiles
from tidemark.operators.training import (
    classification_report, held_out_sizes, median_impute, stratified_split,
)

UP = Score("up", "v")
DOWN = Score("down", "v", descending=True)


def windowed(df, buckets):
    """The plain single-task windows the distributed scores must equal."""
    return df.select(
        "*",
        F.ntile(buckets).over(Window.orderBy(F.col("v").asc_nulls_last(), "id")).alias("up"),
        F.ntile(buckets).over(Window.orderBy(F.col("v").desc_nulls_first(), "id")).alias("down"),
    )


def check(df, buckets=5):
    got = with_ntiles(df, [UP, DOWN], "id", buckets)
    want = windowed(df, buckets)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    return got


@pytest.mark.parametrize("n", [0, 1, 3, 5, 12, 1003])
def test_equals_a_global_window(spark, n):
    rng = random.Random(n)
    rows = [
        (f"k{i:05d}", None if rng.random() < 0.1 else float(rng.randrange(20))) for i in range(n)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, v double")
    got = check(df)
    sizes = [row["count"] for row in got.groupBy("up").count().collect()]
    assert not sizes or max(sizes) - min(sizes) <= 1


def test_one_value_for_a_third_of_all_rows(spark):
    df = spark.range(3000).select(
        F.format_string("k%05d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 7).alias("v"),
    )
    check(df, buckets=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=30),
       buckets=st.integers(2, 7))
def test_any_values(spark, values, buckets):
    df = spark.createDataFrame(
        [(f"k{i:03d}", v) for i, v in enumerate(values)], "id string, v int"
    )
    check(df, buckets)


def test_scoring_needs_no_shuffle_or_window(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    plan = with_ntiles(df, [UP], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_medians_interpolate(spark):
    df = spark.createDataFrame(
        [(1.0, 4), (2.0, 4), (3.0, None), (10.0, 9)], "a double, b int"
    )
    assert exact_medians(df, ["a", "b"]) == {"a": 2.5, "b": 4.0}
    filled = median_impute(df, ["a", "b"]).collect()
    assert sorted(r.b for r in filled) == [4.0, 4.0, 4.0, 9.0]


def test_medians_of_many_values(spark):
    rng = random.Random(1)
    rows = [(rng.random(), rng.randrange(3)) for _ in range(1001)]
    df = spark.createDataFrame(rows, "a double, b int").repartition(7)
    got = exact_medians(df, ["a", "b"])
    assert got["a"] == statistics.median(r[0] for r in rows)
    assert got["b"] == statistics.median(r[1] for r in rows)


def test_a_column_without_values_has_no_median(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(ValueError, match="b"):
        exact_medians(df, ["a", "b"])


def test_held_out_sizes_follow_largest_remainders():
    assert held_out_sizes({0: 1085, 1: 166}, 0.2) == {0: 218, 1: 33}
    assert held_out_sizes({0: 80, 1: 20}, 0.2) == {0: 16, 1: 4}
    for a in range(1, 12):
        for b in range(1, 12):
            sizes = held_out_sizes({0: a, 1: b}, 0.2)
            assert sum(sizes.values()) == -(-(a + b) // 5)


def test_split_is_stratified_exact_and_repeatable(spark):
    df = spark.range(1251).select(
        F.col("id").cast("string").alias("id"), (F.col("id") < 166).cast("int").alias("churned")
    )
    first = stratified_split(df, "churned", "id")
    counts = {(r.churned, r.held_out): r["count"] for r in
              first.groupBy("churned", "held_out").count().collect()}
    assert counts == {(0, True): 218, (0, False): 867, (1, True): 33, (1, False): 133}
    again = stratified_split(df.repartition(5), "churned", "id")
    assert first.exceptAll(again).count() == 0
    other = stratified_split(df, "churned", "id", seed=7)
    assert first.exceptAll(other).count() > 0


def test_classification_report(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] * 2
    df = spark.createDataFrame(pairs, "churned int, churn_prediction int")
    rows = {r["class"]: r for r in classification_report(df).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].support) == (0.6, 0.75, 4)
    assert rows["1"].f1_score == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert rows["accuracy"].f1_score == 0.7 and rows["accuracy"].precision is None
    assert rows["macro avg"].precision == pytest.approx((0.6 + 0.8) / 2)
    assert rows["weighted avg"].recall == pytest.approx(0.7)
    assert rows["weighted avg"].support == 10


def test_report_without_a_predicted_class(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "churned int, churn_prediction int")
    rows = {r["class"]: r for r in classification_report(df).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1_score) == (0.0, 0.0, 0.0)
