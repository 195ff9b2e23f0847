"""Exact ntile scores and medians over data of any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.order_statistics import beyond, rows_at_ranks


@dataclass(frozen=True)
class Score:
    """An ntile column ``name`` over the order of ``source``; nulls count as the largest value."""

    name: str
    source: str
    descending: bool = False

    def key(self, tie_break: str) -> list[Column]:
        """Ascending sort key: where nulls stand, the value, and the row's own id."""
        value = F.col(self.source).cast("double")
        if self.descending:
            value = -value
        missing = F.col(self.source).isNull()
        return [
            F.when(missing, -1 if self.descending else 1).otherwise(0).alias("side"),
            F.coalesce(value, F.lit(0.0)).alias("key"),
            F.col(tie_break).alias("id"),
        ]


def with_ntiles(
    df: DataFrame, scores: Sequence[Score], tie_break: str, buckets: int = 5
) -> DataFrame:
    """Add ``ntile(buckets)`` columns, equal to one global window per score.

    ``tie_break`` must be unique. ``df`` should be stored data: it is read once to find the last
    row of each bucket and once more to be scored, and both reads must agree. Scoring compares
    a row with ``buckets - 1`` constants, so it keeps partitioning and needs no shuffle.
    """
    keyed = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(score.name).alias("score"), *score.key(tie_break))
                    for score in scores
                ]
            )
        )
    )

    def bucket_ends(totals: dict[str, int]) -> dict[tuple[str, int], int]:
        # The first (total mod buckets) buckets hold one row more than the others.
        return {
            (name, slot): slot * (total // buckets) + min(slot, total % buckets)
            for name, total in totals.items()
            for slot in range(1, buckets)
        }

    last_rows = rows_at_ranks(keyed, "score", ["side", "key", "id"], bucket_ends, "ntile-keys")

    types = ["int", "double", df.schema[tie_break].dataType]

    def bucket(score: Score) -> Column:
        here = F.struct(*score.key(tie_break))
        number = F.lit(1)
        for slot in range(1, buckets):
            if (score.name, slot) in last_rows:
                number = number + beyond(here, last_rows[score.name, slot], types).cast("int")
        return number.alias(score.name)

    return df.select("*", *[bucket(score) for score in scores])


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Interpolated median of each column over its non-null values.

    Equal values are counted together before the sort. The result is one number per column.
    """
    values = (
        df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("column"), F.col(name).cast("double").alias("value")
                        )
                        for name in columns
                    ]
                )
            )
        )
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("copies"))
    )

    def middle(totals: dict[str, int]) -> dict[tuple[str, int], int]:
        ranks = {}
        for name, total in totals.items():
            ranks[name, 0] = (total + 1) // 2
            ranks[name, 1] = total // 2 + 1
        return ranks

    found = rows_at_ranks(values, "column", ["value"], middle, "median-values", copies="copies")
    medians = {
        name: (found[name, 0][0] + found[name, 1][0]) / 2
        for name in columns
        if (name, 0) in found
    }
    empty = [name for name in columns if name not in medians]
    if empty:
        raise ValueError(f"no value to take a median of in: {', '.join(empty)}")
    return medians
