"""Token-id files: Parquet list columns with chosen encodings, row groups and page indexes.

``write_token_files`` encodes every text, appends the end id and writes files in ascending id order.
Ids are a dictionary-encoded list column (two bytes or less for each id); document numbers and counts
are delta encoded; row groups and pages are small enough that their min/max indexes let a reader skip
to the documents it wants. ``read_metadata`` touches only the narrow columns, ``read_tokens`` only the
pages of the wanted documents, and ``read_positions`` adds where each document starts in the whole run
of ids.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` sorts first; rows with one
``doc_id`` are all written, ordered by a digest of their text; an empty table gives no rows; columns
other than the two named ones are left out, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import bounded_batches, partitions_for, text_of

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
PAGE_BYTES = 64 << 10
PAGE_ROWS = 256
ROW_GROUP_BYTES = 32 << 20
OUTPUT_BYTES = 8 << 20


def parquet_options(row_group_bytes: int, page_bytes: int, page_rows: int) -> dict[str, str]:
    """Delta encoding for the narrow columns, a dictionary for the ids, bounded pages and groups."""
    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "true",
    }
    for name in ("doc_id", "part", "part_start", "n_tokens"):
        options[f"parquet.enable.dictionary#{name}"] = "false"
    return options


def _encode_partition(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, end, before = bpe.encoder(vocabulary), np.uint32(end_id).tobytes(), 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for start, texts in bpe.by_bytes(batch.column("text"), bpe.ENCODED_BYTES):
                ids = [blob + end for blob in encoder.encode(texts)]
                counts = np.array([len(blob) // 4 for blob in ids], dtype="<i8")
                offsets = np.concatenate([[0], np.cumsum(counts)])
                flat = pa.Array.from_buffers(
                    pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(start, len(texts)),
                        pa.array(np.full(len(ids), part, dtype="<i4")),
                        pa.array(before + offsets[:-1]),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                before += int(offsets[-1])
        encoder.rest()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = bpe.VOCABULARY,
    end_id: int = 0,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending ``doc_id`` order.

    Texts are dealt out by ranges of ``doc_id`` first and encoded where they are written: ids pass no
    shuffle, and the sampling for the ranges does not encode anything.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(partitions_for(rows), "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    encoded = ordered.mapInArrow(_encode_partition(vocabulary, end_id), FILE_SCHEMA)
    encoded.write.options(**parquet_options(row_group_bytes, page_bytes, page_rows)).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None):
    """Documents with their ids; bounds on ``doc_id`` reach the file, row group and page indexes."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Document numbers and counts; the id column is not read."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).drop("ids")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """For each file, the ids of all files before it. One row a file."""
    sums = read_metadata(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(_before_part())
    return sums.select("part", F.coalesce(before, F.lit(0)).alias("part_base"))


def _before_part():
    from pyspark.sql import Window

    return Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def with_positions(rows: DataFrame, path: str) -> DataFrame:
    """Replace the place in the file (part, part_start) by ``start`` in the whole run of ids.

    The side that is broadcast has one row for each file written.
    """
    bases = F.broadcast(part_starts(rows.sparkSession, path))
    return rows.join(bases, "part").withColumn(
        "start", F.col("part_base") + F.col("part_start")
    ).drop("part", "part_start", "part_base")


def _crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = memoryview(ids.values.to_numpy(zero_copy_only=True)).cast("B")
        bounds = ids.offsets.to_numpy()
        crcs = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        narrow = [batch.column(n) for n in ("doc_id", "part", "part_start", "n_tokens")]
        yield pa.RecordBatch.from_arrays(
            [*narrow, pa.array(crcs, pa.int64())],
            names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, crc32 of the ids as unsigned 32-bit integers."""
    schema = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"
    checked = read_tokens(spark, path).mapInArrow(_crc_batches, schema)
    return with_positions(checked, path).select("doc_id", "start", "n_tokens", "ids_crc32")
