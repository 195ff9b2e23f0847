"""Preparing labelled rows for a classifier and reporting on its predictions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators.order_statistics import beyond, draw, rows_at_ranks
from tidemark.operators.quantiles import exact_medians

SPLIT_SEED = 42


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Cast the columns to double and replace their nulls."""
    filled = {
        name: F.coalesce(F.col(name).cast("double"), F.lit(median))
        for name, median in medians.items()
    }
    return df.withColumns(filled)


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with each column's median over all rows."""
    return fill_medians(df, exact_medians(df, columns))


def held_out_sizes(class_sizes: dict[int, int], test_share: float) -> dict[int, int]:
    """Rows of each class to hold out.

    ceil(share x rows) are held out in all. Training rows are shared out in proportion to class
    size by largest remainder; what is left of a class is held out.
    """
    rows = sum(class_sizes.values())
    training_rows = rows - math.ceil(test_share * rows)
    quota = {label: training_rows * size / rows for label, size in class_sizes.items()}
    kept = {label: math.floor(share) for label, share in quota.items()}
    by_remainder = sorted(quota, key=lambda label: (kept[label] - quota[label], label))
    for label in by_remainder[: training_rows - sum(kept.values())]:
        kept[label] += 1
    return {label: size - kept[label] for label, size in class_sizes.items()}


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    test_share: float = 0.2,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``held_out``: an exact, repeatable share of every class, picked by a seeded hash.

    ``label`` has a few values and ``row_id`` is unique. The last held-out row of each class is
    found without collecting a class in one task; membership is then a comparison per row.
    """
    place = [
        draw(row_id, seed).alias("place"),
        F.col(row_id).alias("id"),
    ]

    def sizes(class_sizes: dict) -> dict:
        return {
            (key, 0): size
            for key, size in held_out_sizes(class_sizes, test_share).items()
            if size
        }

    last = rows_at_ranks(df.select(label, *place), label, ["place", "id"], sizes, "split-keys")
    types = ["string", df.schema[row_id].dataType]
    held_out = F.lit(False)
    for (key, _), row in last.items():
        held_out = F.when(F.col(label) == key, ~beyond(F.struct(*place), row, types)).otherwise(held_out)
    return df.withColumn("held_out", held_out)


def classification_report(
    df: DataFrame, label: str = "churned", prediction: str = "churn_prediction"
) -> DataFrame:
    """Precision, recall, f1 and support per class, with accuracy and both averages.

    One pass counts the (label, prediction) pairs; the rest is arithmetic on those few rows.
    Undefined ratios are 0. Accuracy stands in the f1 column, as such reports print it.
    """
    pairs = df.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    classes = (
        pairs.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("actual").alias("class"),
                        F.col("n").alias("support"),
                        F.lit(0).cast("long").alias("named"),
                        hit.alias("hits"),
                    ),
                    F.struct(
                        F.col("predicted").alias("class"),
                        F.lit(0).cast("long").alias("support"),
                        F.col("n").alias("named"),
                        F.lit(0).cast("long").alias("hits"),
                    ),
                )
            )
        )
        .groupBy("class")
        .agg(*[F.sum(name).alias(name) for name in ("support", "named", "hits")])
        .select(
            F.col("class").cast("string").alias("class"),
            _defined(ratio(F.col("hits"), F.col("named"))).alias("precision"),
            _defined(ratio(F.col("hits"), F.col("support"))).alias("recall"),
            _defined(ratio(2 * F.col("hits"), F.col("named") + F.col("support"))).alias(
                "f1_score"
            ),
            "support",
            "hits",
        )
    )
    measures = ("precision", "recall", "f1_score")
    support = F.sum("support")
    accuracy = classes.agg(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        ratio(F.sum("hits"), support).alias("f1_score"),
        support.alias("support"),
    )
    macro = classes.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(name).alias(name) for name in measures],
        support.alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(F.col(name) * F.col("support")), support).alias(name) for name in measures],
        support.alias("support"),
    )
    return (
        classes.drop("hits").unionByName(accuracy).unionByName(macro).unionByName(weighted)
    )


def _defined(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))
