"""Loading raw tables from CSV files, setting bad rows aside."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import NUMBER_TEXT, TIMESTAMP_TEXT
from tidemark.sources.csv_records import read_records
from tidemark.sources.raw_tables import (
    LOADED_MARKER,
    RAW_TABLES,
    RawColumn,
    loaded_schema,
    path_exists,
    raw_schema,
)

# File of each table, and the texts that stand for null.
CSV_FILES = {
    "customers": "customers_dataset.csv",
    "orders": "orders_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "order_payments": "order_payments_dataset.csv",
    "order_reviews": "order_reviews_dataset.csv",
    "products": "products_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
}
NULL_TEXTS = ("", "NULL", "null")

# Only free text may hold line breaks; see csv_records for how such files are cut.
MULTI_LINE_TABLES = frozenset({"order_reviews"})

# Characters of a record beside its texts, and of one whose widths are not known.
SPARE_CHARS = 4096
MOST_RECORD_CHARS = 1 << 16

_BROKEN = "_broken_line"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class LoadResult:
    """A loaded table: its typed rows, and the rejected rows as text with the reason."""

    table: str
    stored: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.stored.filter(~F.col("rejected")).drop("reject", "rejected")

    @property
    def rejects(self) -> DataFrame:
        return self.stored.filter("rejected").select("reject.*")

    def status(self) -> DataFrame:
        """One row: table_name, rows_loaded, rows_rejected."""
        return self.stored.agg(
            F.count(F.when(~F.col("rejected"), 1)).alias("rows_loaded"),
            F.count(F.when(F.col("rejected"), 1)).alias("rows_rejected"),
        ).select(F.lit(self.table).alias("table_name"), "rows_loaded", "rows_rejected")


def read_text_columns(spark: SparkSession, table: str, path: str) -> DataFrame:
    """All columns of a raw table as trimmed text, see ``read_lines``."""
    columns = RAW_TABLES[table]
    # quotes inside a text are doubled
    most = SPARE_CHARS + sum(2 * (column.width or 0) for column in columns)
    return read_lines(spark, [c.name for c in columns], path, table in MULTI_LINE_TABLES, most)


def read_lines(
    spark: SparkSession,
    names: list[str],
    path: str | list[str],
    multi_line: bool,
    most_chars: int = MOST_RECORD_CHARS,
) -> DataFrame:
    """Named columns as trimmed text with null texts resolved, plus the line if it is malformed.

    Lines with too few or too many fields are malformed. With ``multi_line`` a record may go over
    several lines, up to ``most_chars`` in all; a line that opens a quote without such an end is
    malformed alone. Files are split over tasks; a gzipped file is one task.
    """
    fields = [*names, _BROKEN]
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BROKEN,
        **_dialect(),
    }
    if multi_line:
        records = read_records(spark, path, len(names), most_chars)
        schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in fields)
        parsed = F.from_csv("text", schema, {k: str(v) for k, v in options.items()})
        lines = records.select(
            F.when(~F.col("broken"), parsed).alias("found"), "text", "broken"
        ).select(
            *[F.col("found").getField(name).alias(name) for name in names],
            F.when(F.col("broken"), F.col("text")).otherwise(F.col("found")[_BROKEN]).alias(_BROKEN),
        )
    else:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
        reader = spark.read.schema(schema).options(**options, header=True)
        lines = reader.option("columnPruning", False).option("enforceSchema", True).csv(path)
    return lines.select(*[_resolve(name) for name in names], _BROKEN)


def _dialect() -> dict[str, str | bool]:
    return {
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
    }


def _resolve(name: str) -> Column:
    text = F.trim(F.col(quoted(name)))
    return F.when(~text.isin(*NULL_TEXTS), text).alias(name)


def _typed(column: RawColumn) -> Column:
    """The value in the column's type, null where the text does not fit it."""
    text = F.col(column.name)
    if column.kind == "text":
        return text
    pattern = NUMBER_TEXT if column.kind in ("int", "double") else TIMESTAMP_TEXT
    text = F.when(text.rlike(pattern), text)
    if column.kind == "int":
        return F.round(text.try_cast("double")).try_cast("int")
    return text.try_cast(column.spark_type)


def _problem(column: RawColumn) -> Column:
    """A message if the text cannot be stored in the column, else null."""
    text = F.col(column.name)
    if column.kind == "text":
        return F.when(F.length(text) > column.width, f"{column.name}: too long")
    return F.when(
        text.isNotNull() & _typed(column).isNull(), f"{column.name}: not {column.kind}"
    )


def load_csv(spark: SparkSession, table: str, path: str, target: str) -> LoadResult:
    """Load one table into ``<target>/<table>``, replacing what is there.

    Malformed lines, values of the wrong type and over-long texts are set aside and the load
    goes on. The CSV is parsed and written once, partitioned by ``rejected``: readers of the
    good rows never open the files of the others.
    """
    return store_lines(read_text_columns(spark, table, path), table, target)


def store_lines(lines: DataFrame, table: str, target: str) -> LoadResult:
    """Check, type and store the text columns of one table, as ``load_csv`` does."""
    columns = RAW_TABLES[table]
    names = [column.name for column in columns]
    reason = F.coalesce(
        F.when(F.col(_BROKEN).isNotNull(), "malformed line"),
        *[_problem(column) for column in columns],
    )
    typed = [F.when(F.col("reason").isNull(), _typed(column)).alias(column.name) for column in columns]
    lines = lines.withColumn("reason", reason)
    return _store(lines, table, names, typed, raw_schema(table), f"{target}/{table}")


def _store(
    lines: DataFrame, table: str, names: list[str], typed: list[Column], schema: T.StructType, path: str
) -> LoadResult:
    """Write good and rejected rows once, apart, and mark the folder as loaded."""
    spark, good = lines.sparkSession, F.col("reason").isNull()
    reject = F.struct(
        F.col("reason"), F.col(_BROKEN).alias("line"), *[F.col(quoted(name)) for name in names]
    )
    lines.select(
        *typed, F.when(~good, reject).alias("reject"), (~good).alias("rejected")
    ).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "rejected"
    ).parquet(path)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{LOADED_MARKER}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    marker.getFileSystem(conf).create(marker, True).close()
    return LoadResult(table, spark.read.schema(loaded_schema(schema)).parquet(path))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that a task reads of each file."""
    known: set[str] = set()
    for batch in batches:
        files = batch.column("file")
        fresh = [file for file in pc.unique(files).to_pylist() if file not in known]
        known.update(fresh)
        yield batch.take(pa.array([pc.index(files, file).as_py() for file in fresh], pa.int64()))


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The column names of every file at a path, from its first line; one short row a file.

    One task reads the first block of a file, line by line in order, and keeps a single line of it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    begins = lines.filter(F.col("block") == 0).select("file", "line")
    first = begins.mapInArrow(_first_lines, "file string, line string")
    return {
        row["file"]: [name.strip() for name in next(csv.reader([row["line"]], skipinitialspace=True))]
        for row in first.filter(F.trim("line") != "").orderBy("file").collect()
    }


def header_report(spark: SparkSession, found: dict[str, list[str]]) -> DataFrame:
    """Files whose columns are not those of all files together: file, missing columns."""
    names = dict.fromkeys(name for own in found.values() for name in own)
    rows = [
        (file.rsplit("/", 1)[-1], [name for name in names if name not in own])
        for file, own in found.items()
    ]
    return spark.createDataFrame([r for r in rows if r[1]], "file string, missing array<string>")


def load_csv_as_text(
    spark: SparkSession, path: str, target: str, multi_line: bool = False
) -> LoadResult:
    """A CSV with every column as text, named by its header; typing is left to staging.

    Each file's values go under the names of its own header; a column that a file does not have is
    null there (``header_report`` names them). Lines with too few or too many fields for their file
    are set aside and counted, as in ``load_csv``. The result is stored in ``target``, replacing
    what is there.
    """
    found = headers(spark, path)
    names = list(dict.fromkeys(name for own in found.values() for name in own))
    alike: dict[tuple[str, ...], list[str]] = {}
    for file, own in found.items():
        alike.setdefault(tuple(own), []).append(file)
    lines = None
    for own, files in alike.items():
        part = read_lines(spark, list(own), files, multi_line)
        lines = part if lines is None else lines.unionByName(part, allowMissingColumns=True)
    if lines is None:
        raise ValueError(f"no file with a header at {path}")
    broken = F.when(F.col(_BROKEN).isNotNull(), "malformed line")
    lines = lines.withColumn("reason", broken)
    texts = [F.when(F.col("reason").isNull(), F.col(quoted(name))).alias(name) for name in names]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return _store(lines, path.rstrip("/").rsplit("/", 1)[-1], names, texts, schema, target)


def load_directory(spark: SparkSession, source: str, target: str) -> dict[str, LoadResult]:
    """Load every table whose file (or ``.gz`` of it) exists; others are reported and skipped."""
    loaded = {}
    for table, file_name in CSV_FILES.items():
        path = next(
            (
                candidate
                for candidate in (f"{source}/{file_name}", f"{source}/{file_name}.gz")
                if path_exists(spark, candidate)
            ),
            None,
        )
        if path is None:
            print(f"skipped {table}: {source}/{file_name} not found")
            continue
        loaded[table] = load_csv(spark, table, path, target)
    return loaded


def load_status(loaded: dict[str, LoadResult]) -> DataFrame:
    """Rows loaded and rejected per table, in name order."""
    if not loaded:
        schema = "table_name string, rows_loaded long, rows_rejected long"
        return SparkSession.active().createDataFrame([], schema)
    rows = None
    for result in loaded.values():
        one = result.status()
        rows = one if rows is None else rows.unionByName(one)
    return rows.orderBy("table_name")
