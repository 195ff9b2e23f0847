"""Records of CSV files whose quoted fields may hold line breaks, cut by many tasks.

A file is read as lines, block by block, as Spark splits it. Which lines form a record depends on what stands
before them, so each task cuts its block from the first line on that is certain to begin a record, and gives
the lines before it and the unfinished ones behind it to a second step, which joins the end of a block with
the start of the next. A line is certain to begin a record if

- it is the first of a file, or
- read as the inside of a quoted field it breaks the rules of quoting, as any line with a quoted field of its
  own does, or
- no line within ``most_chars`` before it leaves a quote open: a record is no longer than that.

A quote opens a field only at the field's start and closes it only before a delimiter or a line's end; two
quotes inside stand for one. A line that opens a field begins a record of several lines if the quoting is
sound to its end, within ``most_chars``, and the fields are as many as the columns. If not, that line alone is
broken, and the next line is tried: one stray quote costs one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stage

FINISHED, HEAD, TAIL, BLOCK = range(4)
# Small blocks share tasks, block after block: tasks for each core at most.
TASKS_PER_CORE = 16
CUT = "path string, block long, part int, at long, text string, broken boolean"
BLANKS = " \t\r"


def scan(line: str, inside: bool) -> tuple[bool, int, bool]:
    """Read a line that begins inside or outside a quoted field.

    Returns whether it ends inside one, the delimiters outside quotes, and whether the quoting is sound.
    """
    at, n, delimiters = 0, len(line), 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True, delimiters, True
            if line.startswith('""', at):
                at += 2
                continue
            at += 1
            while at < n and line[at] in BLANKS:
                at += 1
            if at == n:
                return False, delimiters, True
            if line[at] != ",":
                return False, delimiters, False
            at, delimiters, inside = at + 1, delimiters + 1, False
        start = at
        while start < n and line[start] in BLANKS:
            start += 1
        if line.startswith('"', start):
            at, inside = start + 1, True
            continue
        at = line.find(",", at) + 1
        if not at:
            return False, delimiters, True
        delimiters += 1


def record_at(lines: list[str], k: int, n_columns: int, most_chars: int) -> tuple[int, bool] | None:
    """The end of the record that begins at a line, and whether it is broken; None if lines are missing."""
    if '"' not in lines[k]:
        return k + 1, False
    inside, delimiters, sound = scan(lines[k], False)
    if not inside or not sound:
        return k + 1, not sound
    size = len(lines[k])
    for j in range(k + 1, len(lines)):
        size += len(lines[j]) + 1
        if size > most_chars:
            return k + 1, True
        inside, more, sound = scan(lines[j], True)
        delimiters += more
        if not sound:
            return k + 1, True
        if not inside:
            return (j + 1, False) if delimiters == n_columns - 1 else (k + 1, True)
    return None


class _Block:
    """The lines of one block as they come in."""

    def __init__(self, path: str, block: int, n_columns: int, most_chars: int):
        self.path, self.block = path, block
        self.n_columns, self.most_chars = n_columns, most_chars
        self.lines: list[str] = []
        self.at, self.quiet, self.looked = 0, 0, 0
        self.started = block == 0

    def rows(self, part: int, lines: list[str], at: int) -> list[tuple]:
        return [(self.path, self.block, part, at + k, line, False) for k, line in enumerate(lines)]

    def add(self, lines: list[str]) -> Iterator[tuple]:
        self.lines += lines
        if not self.started:
            yield from self._find_start()
        k = 0
        while self.started and k < len(self.lines):
            found = record_at(self.lines, k, self.n_columns, self.most_chars)
            if found is None:
                break
            end, broken = found
            text = "\n".join(self.lines[k:end])
            yield self.path, self.block, FINISHED, self.at + k, text, broken
            k = end
        self.lines, self.at = self.lines[k:], self.at + k

    def _find_start(self) -> Iterator[tuple]:
        for k in range(self.looked, len(self.lines)):
            line = self.lines[k]
            if self.quiet > self.most_chars or ('"' in line and not scan(line, True)[2]):
                yield from self.rows(HEAD, self.lines[:k], self.at)
                self.lines, self.at, self.started = self.lines[k:], self.at + k, True
                return
            self.quiet = 0 if '"' in line and scan(line, False)[0] else self.quiet + len(line) + 1
        self.looked = len(self.lines)

    def end(self) -> Iterator[tuple]:
        yield from self.rows(TAIL if self.started else HEAD, self.lines, self.at)
        yield self.path, self.block, BLOCK, 0, None, self.started


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["path", "block", "part", "at", "text", "broken"])


def _run_ends(paths: pa.Array, blocks: pa.Array) -> list[int]:
    """The ends of the stretches of lines of one block."""
    if not len(paths):
        return []
    codes, starts = paths.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
    changes = (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])
    return [*(np.flatnonzero(changes) + 1).tolist(), len(codes)]


def _cut(n_columns: int, most_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            paths, blocks, lines = batch.column("path"), batch.column("block"), batch.column("value")
            rows, a = [], 0
            for b in _run_ends(paths, blocks):
                key = paths[a].as_py(), blocks[a].as_py()
                if block is None or (block.path, block.block) != key:
                    rows += block.end() if block else ()
                    block = _Block(*key, n_columns, most_chars)
                rows += block.add(lines[a:b].to_pylist())
                a = b
            yield _batch(rows)
        if block:
            yield _batch(list(block.end()))

    return run


def _joined(n_columns: int, most_chars: int):
    """Records of the lines between two certain starts."""

    def run(piece: pa.Table) -> pa.Table:
        rows = piece.sort_by([("block", "ascending"), ("at", "ascending")]).to_pylist()
        lines, out, k = [row["text"] for row in rows], [], 0
        while k < len(lines):
            end, broken = record_at(lines, k, n_columns, most_chars) or (k + 1, True)
            out.append((rows[k]["path"], rows[k]["block"], FINISHED, rows[k]["at"],
                        "\n".join(lines[k:end]), broken))
            k = end
        return pa.Table.from_batches([_batch(out)])

    return run


def read_records(spark: SparkSession, path: str, n_columns: int, most_chars: int) -> DataFrame:
    """(path, text, broken) of all records of the files at a path but the first of each, the header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    lines = lines.coalesce(TASKS_PER_CORE * max(1, spark.sparkContext.defaultParallelism))
    cut = stage(lines.mapInArrow(_cut(n_columns, most_chars), CUT), "csv-records")
    # pieces are numbered by the blocks with a start before them; there is one row a block
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.sum(F.col("broken").cast("long")).over(before)
    blocks = cut.filter(F.col("part") == BLOCK).select(
        "path", "block", F.coalesce(starts, F.lit(0)).alias("piece")
    )
    ends = cut.filter(F.col("part").isin(HEAD, TAIL)).join(blocks, ["path", "block"])
    pieces = ends.withColumn("piece", F.col("piece") + (F.col("part") == TAIL).cast("long"))
    # tail and head of the next block share a number: a tail comes after its own start
    joined = pieces.groupBy("path", "piece").applyInArrow(_joined(n_columns, most_chars), CUT)
    whole = cut.filter(F.col("part") == FINISHED).unionByName(joined)
    header = (F.col("block") == 0) & (F.col("at") == 0)
    return whole.filter(~header).select("path", "text", "broken")
