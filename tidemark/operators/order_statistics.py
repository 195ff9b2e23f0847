"""Rows at given ranks of a distributed total order.

A window without partitions would sort everything in one task. Here the rows are range
partitioned and stored once, each stretch is counted, and only the few stretches that hold a
wanted rank are numbered. The driver sees one count per range partition (as it does when Spark
numbers rows with ``zipWithIndex``) and the rows found, never the data. Consumers then compare
each row with the found rows, which needs neither a shuffle nor a join.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Hashable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stage

Place = tuple[Hashable, int]  # a group and the slot of a wanted row in it


def rows_at_ranks(
    rows: DataFrame,
    group: str,
    order: Sequence[str],
    wanted: Callable[[dict], dict[Place, int]],
    label: str,
    copies: str | None = None,
) -> dict[Place, tuple]:
    """The ``order`` values of the row at each wanted rank.

    ``order`` must identify a row within its group, so equal keys spread over partitions too.
    ``wanted`` maps the group sizes to ranks by (group, slot), ranks starting at 1; it asks for
    a fixed number of rows. ``copies`` names a column telling how many equal rows each row
    stands for.
    """
    weight = F.col(copies) if copies else F.lit(1)
    # Range bounds come from a sample: without the stored copy a second pass could draw others.
    placed = stage(
        rows.select(group, *order, weight.cast("long").alias("_n"))
        .repartitionByRange(group, *order)
        .withColumn("_stretch", F.spark_partition_id()),
        label,
    )
    counted = placed.groupBy(group, "_stretch").agg(F.sum("_n").alias("_size")).collect()
    stretches: dict[Hashable, list[tuple[int, int]]] = {}
    for row in sorted(counted, key=lambda row: row["_stretch"]):
        stretches.setdefault(row[group], []).append((row["_stretch"], row["_size"]))
    totals = {key: sum(size for _, size in parts) for key, parts in stretches.items()}

    targets = {}
    for (key, slot), rank in wanted(totals).items():
        before = 0
        for stretch, size in stretches[key]:
            if before < rank <= before + size:
                targets[key, slot] = (stretch, rank - before)
                break
            before += size
    if not targets:
        return {}

    # Literal conditions, so that the scan skips the files of all other stretches.
    in_group, in_stretch, upto, size = F.col(group), F.col("_stretch"), F.col("_upto"), F.col("_n")
    places = {
        (key, stretch): (in_group == key) & (in_stretch == stretch)
        for (key, _), (stretch, _) in targets.items()
    }
    within = Window.partitionBy(group, "_stretch").orderBy(*order)
    found = (
        placed.filter(_any_of(places.values()))
        .withColumn("_upto", F.sum(size).over(within))
        .filter(
            _any_of(
                places[key, stretch] & (upto >= rank) & (upto - size < rank)
                for (key, _), (stretch, rank) in targets.items()
            )
        )
        .collect()
    )
    return {
        (key, slot): tuple(row[name] for name in order)
        for (key, slot), (stretch, rank) in targets.items()
        for row in found
        if row[group] == key
        and row["_stretch"] == stretch
        and row["_upto"] - row["_n"] < rank <= row["_upto"]
    }


def draw(row_id: str, seed: int) -> Column:
    """A repeatable random order of rows that other engines compute alike."""
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f"-{seed}")))


def beyond(here: Column, row: tuple, types: Sequence[T.DataType | str]) -> Column:
    """Whether a row, its order columns packed in ``here``, stands after the found ``row``."""
    return here > F.struct(*[F.lit(value).cast(kind) for value, kind in zip(row, types)])


def _any_of(conditions) -> Column:
    return functools.reduce(Column.__or__, conditions)
