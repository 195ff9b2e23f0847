from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.shop import at
from tidemark.functions.dates import day_diff
from tidemark.functions.display import percent, reais, thousands
from tidemark.functions.numbers import mean, ratio, total, whole_number
from tidemark.functions.risk import risk_tier


def test_day_difference_counts_midnights(spark):
    pairs = [
        ("2020-01-01 23:00:00", "2020-01-02 01:00:00", 1),
        ("2020-01-01 01:00:00", "2020-01-01 23:00:00", 0),
        ("2020-01-02 01:00:00", "2020-01-01 23:00:00", -1),
        ("2020-01-01 01:00:00", None, None),
    ]
    df = spark.createDataFrame(
        [(at(a), at(b), c) for a, b, c in pairs], "a timestamp_ntz, b timestamp_ntz, c int"
    )
    for row in df.withColumn("d", day_diff("a", "b")).collect():
        assert row.d == row.c


def test_text_to_whole_number_rounds_and_rejects_words(spark):
    df = spark.createDataFrame([("1.6", 2), ("2.5", 3), ("-2.5", -3), (None, None)], "t string, n int")
    for row in df.withColumn("got", whole_number(df, "t")).collect():
        assert row.got == row.n
    bad = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(PySparkException):
        bad.select(whole_number(bad, "t")).collect()


def test_double_to_whole_number_rounds(spark):
    df = spark.createDataFrame([(1.6,), (2.5,)], "v double")
    assert [r[0] for r in df.select(whole_number(df, "v")).collect()] == [2, 3]


def test_risk_tiers_are_right_closed(spark):
    edges = [
        (0.0, "Low"), (0.3, "Low"), (0.3000001, "Medium"), (0.6, "Medium"), (0.6000001, "High"),
        (0.8, "High"), (0.8000001, "Critical"), (1.0, "Critical"),
        (1.1, None), (-0.1, None), (None, None),
    ]
    df = spark.createDataFrame(edges, "p double, tier string")
    for row in df.withColumn("got", risk_tier(F.col("p"))).collect():
        assert row.got == row.tier, row


def test_ratio_of_zero_is_null(spark):
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), ratio(F.lit(1), F.lit(4))).first()
    assert (row[0], row[1]) == (None, 0.25)


def test_exact_sums_do_not_depend_on_order(spark):
    values = [(0.1,)] * 10 + [(None,)]
    row = spark.createDataFrame(values, "v double").agg(
        total(F.col("v"), exact=True), mean(F.col("v"), exact=True), mean(F.col("v"))
    ).first()
    assert row[0] == 1.0 and row[1] == 0.1 and row[2] == pytest.approx(0.1)


def test_display_formats(spark):
    row = spark.range(1).select(
        thousands(F.lit(1234567)), percent(F.lit(0.1327)), reais(F.lit(1234.6))
    ).first()
    assert tuple(row) == ("1,234,567", "13%", "R$1,235")
