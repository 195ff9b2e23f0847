"""Helpers shared by the corpus operators: stored intermediate tables, row ids, partition counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors share."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_id() -> Column:
    """A number for each row of a frame, for one evaluation only: store what carries it.

    It follows from the split of the input, which Spark sizes by the cores registered when the read is
    planned; a second read can number the rows otherwise.
    """
    return F.monotonically_increasing_id()


def free_name(columns: list[str], base: str) -> str:
    """A column name that none of ``columns`` has; Spark does not tell case apart."""
    taken = {name.lower() for name in columns}
    return next(name for k in range(len(taken) + 1) if (name := f"{base}_{k}") not in taken)


def quoted(name: str) -> str:
    """A column name as ``select`` takes it, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def with_row_numbers(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with one more column of row numbers, the same in every later read; its name."""
    name = free_name(docs.columns, "row_number")
    return stored(docs.withColumn(name, row_id()), "numbered-rows"), name


def partitions_for(df: DataFrame, target_bytes: int = 64 << 20) -> int:
    """Partitions for a shuffle of ``df``: the session's number, or more where the data ask for it.

    A frame that is not read from files has no known size; the session's number holds for it.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return configured if size >= 1 << 60 else max(configured, -(-size // target_bytes))


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Smaller Arrow batches for columns of whole texts, unless the session's owner chose a number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(rows))


def bounded_bytes(spark: SparkSession, size: int = 16 << 20) -> None:
    """Arrow batches of so many bytes for rows that are large, unless the session's owner chose a size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(size))


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


def slices_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes sum to ``most`` or less, one item at least."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if k > start and total + size > most:
            yield start, k
            start, total = k, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)
