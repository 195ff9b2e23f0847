"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of the tokens of its documents. A window of ``window_tokens`` is one round:
source s earns its share of the window as credit, and is served in units of ``unit_tokens`` while its
credit lasts; what is left of the credit, its deficit, is carried to the next window, through all
partitions. As a queue earns the same credit in each round, the round that serves a token follows from
the token's place in its queue alone:

    served(r) = unit * floor(r * share * window / unit)        tokens served in the first r rounds

so the rounds need no loop: prefix sums give places in the queues, places give rounds, and prefix sums
over the runs (round, source) give places in the packed stream, which is cut into sequences of
``sequence_tokens``. Only the last sequence is not full. Without targets the shares are those of the
corpus, and all queues end together; with targets, a queue that has ended earns nothing, and the
others go on in their proportions.

A document may be cut by the end of a run or of a sequence; each id lies in exactly one piece.

Defined cases: a null or empty text is its end id alone; a null source is a queue of its own; rows
with one doc_id are packed separately; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import bounded_batches, stored, text_of

SEQUENCE_TOKENS = 2048
WINDOW_TOKENS = 32 * SEQUENCE_TOKENS
UNIT_TOKENS = 256
ROUNDS_PER_BLOCK = 1024

TOKEN_SCHEMA = (
    "part int, place long, doc_id long, queue string, queue_start long, doc_tokens long, ids binary"
)
PIECE_SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def _tokenize(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, ends = TaskContext.get().partitionId(), 0, Counter()
        encoder, end = bpe.encoder(vocabulary), np.uint32(end_id).tobytes()
        # stored and shuffled in two bytes where all ids fit
        short = max(encoder.size - 1, end_id) < 1 << 16
        for batch in batches:
            for first, texts in bpe.by_bytes(batch.column("text"), bpe.ENCODED_BYTES):
                ids = [blob + end for blob in encoder.encode(texts)]
                counts = [len(blob) // 4 for blob in ids]
                if short:
                    ids = [np.frombuffer(blob, "<u4").astype("<u2").tobytes() for blob in ids]
                queues = batch.column("queue").slice(first, len(texts))
                starts = []
                for queue, count in zip(queues.to_pylist(), counts, strict=True):
                    starts.append(ends[queue])
                    ends[queue] += count
                columns = [
                    pa.array(np.full(len(ids), part, dtype="<i4")),
                    pa.array(np.arange(place, place + len(ids))),
                    batch.column("doc_id").slice(first, len(texts)),
                    queues,
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                names = [f.split()[0] for f in TOKEN_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                place += len(ids)
        encoder.rest()

    return run


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Encode every text where it lies, once, and store the ids with their place.

    ``queue_start`` counts the tokens of the same queue earlier in the partition.
    """
    bounded_batches(docs.sparkSession)
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"), text_of().alias("text")
    )
    return stored(rows.mapInArrow(_tokenize(vocabulary, end_id), TOKEN_SCHEMA), "packing-tokens")


def _queue_places(tokens: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """For each partition and queue: tokens of the queue in earlier partitions, and the queue's share.

    One row a partition and source; the windows below hold one row a partition.
    """
    sums = tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("tokens"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    queue = Window.partitionBy("queue")
    placed = sums.select(
        "queue",
        "part",
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"),
        F.sum("tokens").over(queue).alias("queue_tokens"),
    )
    if targets is None:
        total = tokens.agg(F.sum("doc_tokens").alias("tokens")).first()["tokens"] or 1
        share = F.col("queue_tokens") / F.lit(float(total))
    else:
        weight = sum(targets.values())
        named = {"null" if k is None else f"={k}": v / weight for k, v in targets.items()}
        share = F.lit(0.0)
        for name, value in named.items():
            share = F.when(F.col("queue") == name, F.lit(value)).otherwise(share)
    return placed.select("queue", "part", "base", share.alias("share"))


def _served(rounds: Column, rate: Column, unit: int) -> Column:
    """Tokens that a queue has been served after so many rounds; ``rate`` is units a round."""
    return F.floor(rounds * rate) * F.lit(unit)


def _round_of(token: Column, rate: Column, unit: int) -> Column:
    """The first round r with served(r) > token; the estimate is set right by served() itself."""
    units = F.floor(token / F.lit(unit)) + 1
    guess = F.ceil(units / rate)
    return (
        F.when(F.floor((guess - 1) * rate) >= units, guess - 1)
        .when(F.floor(guess * rate) < units, guess + 1)
        .otherwise(guess)
    )


def runs_of(tokens: DataFrame, places: DataFrame, window_tokens: int, unit: int) -> DataFrame:
    """Documents cut by rounds: (part, place, queue, round, low, high, first) in queue positions.

    A source without a target, or with too small a share to be served in 2**40 rounds, is served
    after all others, in one last round.
    """
    last = F.lit(1 << 40)
    rate = F.col("share") * F.lit(window_tokens / unit)
    low, high = F.col("first"), F.col("first") + F.col("doc_tokens")
    served = F.when(F.col("rate") * last < 1, F.lit(None)).otherwise(F.col("rate"))
    cut = (
        tokens.select("part", "place", "queue", "queue_start", "doc_tokens")
        .join(places, ["queue", "part"])
        .withColumn("first", F.col("base") + F.col("queue_start"))
        .withColumn("rate", rate)
        .withColumn("rate", served)
        .withColumn("from_round", F.coalesce(_round_of(low, F.col("rate"), unit), last))
        .withColumn("to_round", F.coalesce(_round_of(high - 1, F.col("rate"), unit), last))
        .withColumn("round", F.explode(F.sequence("from_round", "to_round")))
    )
    before = F.coalesce(_served(F.col("round") - 1, F.col("rate"), unit), low)
    after = F.coalesce(_served(F.col("round"), F.col("rate"), unit), high)
    return cut.select(
        "part",
        "place",
        "queue",
        "round",
        "first",
        F.greatest(low, before).alias("low"),
        F.least(high, after).alias("high"),
    ).filter("high > low")


def _stream_places(runs: DataFrame) -> DataFrame:
    """Where each run (round, queue) starts in the packed stream, and in its queue.

    Prefix sums in three steps: queues of a round, rounds of a block, blocks. The last step has one
    row for each ``ROUNDS_PER_BLOCK`` windows, 67 million tokens at the defaults.
    """
    totals = runs.groupBy("round", "queue").agg(
        F.sum(F.col("high") - F.col("low")).alias("tokens"), F.min("low").alias("run_low")
    )
    in_round = Window.partitionBy("round").orderBy("queue")
    totals = totals.select(
        "round",
        "queue",
        "run_low",
        (F.sum("tokens").over(in_round) - F.col("tokens")).alias("before_queue"),
        F.sum("tokens").over(Window.partitionBy("round")).alias("round_tokens"),
        F.row_number().over(in_round).alias("rank"),
        F.floor(F.col("round") / ROUNDS_PER_BLOCK).alias("block"),
    )
    rounds = totals.filter("rank = 1").select("block", "round", "round_tokens")
    in_block = Window.partitionBy("block").orderBy("round")
    rounds = rounds.withColumn(
        "before_round", F.sum("round_tokens").over(in_block) - F.col("round_tokens")
    )
    blocks = rounds.groupBy("block").agg(F.sum("round_tokens").alias("block_tokens"))
    blocks = blocks.select(
        "block",
        (F.sum("block_tokens").over(Window.orderBy("block")) - F.col("block_tokens")).alias(
            "before_block"
        ),
    )
    rounds = rounds.join(blocks, "block").select(
        "round", (F.col("before_block") + F.col("before_round")).alias("before_round")
    )
    return totals.join(rounds, "round").select(
        "round", "queue", "run_low", (F.col("before_round") + F.col("before_queue")).alias("run_at")
    )


def layout(
    tokens: DataFrame,
    sequence_tokens: int,
    window_tokens: int,
    unit_tokens: int,
    targets: dict[str | None, float] | None,
) -> DataFrame:
    """Per document (part, place) its pieces: start, length, sequence_id, offset. Narrow rows only."""
    places = _queue_places(tokens, targets)
    runs = stored(runs_of(tokens, places, window_tokens, unit_tokens), "packing-runs")
    size = F.lit(sequence_tokens)
    at = F.col("run_at") + F.col("low") - F.col("run_low")
    length = F.col("high") - F.col("low")
    cut = (
        runs.join(_stream_places(runs), ["round", "queue"])
        .withColumn("at", at)
        .withColumn("end", F.col("at") + length)
        .withColumn(
            "sequence_id",
            F.explode(
                F.sequence(F.floor(F.col("at") / size), F.floor((F.col("end") - 1) / size))
            ),
        )
        .withColumn("from", F.greatest("at", F.col("sequence_id") * size))
        .withColumn("to", F.least("end", (F.col("sequence_id") + 1) * size))
    )
    piece = F.struct(
        (F.col("low") - F.col("first") + F.col("from") - F.col("at")).alias("start"),
        (F.col("to") - F.col("from")).alias("length"),
        "sequence_id",
        (F.col("from") - F.col("sequence_id") * size).alias("offset"),
    )
    return cut.groupBy("part", "place").agg(F.collect_list(piece).alias("pieces"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the ids by the pieces of each document."""
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
    for batch in batches:
        pieces = batch.column("pieces")
        owner = np.repeat(np.arange(len(pieces)), np.diff(pieces.offsets.to_numpy()))
        flat = pieces.flatten()
        starts, lengths = flat.field("start").to_numpy(), flat.field("length").to_numpy()
        counts = batch.column("doc_tokens").to_pylist()
        views = [
            np.frombuffer(blob.as_buffer(), "<u2" if len(blob.as_buffer()) == 2 * n else "<u4")
            for blob, n in zip(batch.column("ids"), counts, strict=True)
        ]
        ids = [
            views[k][a : a + n].astype("<u4").tobytes()
            for k, a, n in zip(owner, starts, lengths, strict=True)
        ]
        take = pa.array(owner)
        columns = [
            batch.column("doc_id").take(take),
            flat.field("start"),
            flat.field("length"),
            batch.column("doc_tokens").take(take),
            flat.field("sequence_id"),
            flat.field("offset"),
            pa.array(ids, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def pack(
    docs: DataFrame,
    vocabulary: str = bpe.VOCABULARY,
    end_id: int = 1,
    sequence_tokens: int = SEQUENCE_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
    unit_tokens: int = UNIT_TOKENS,
    targets: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text, source): one row a piece, with its ids as unsigned 32-bit bytes.

    ``targets`` gives weights by source. The pieces of a document meet its ids in one shuffle of the
    stored ids; everything before it moves counts only.
    """
    tokens = tokenized(docs, vocabulary, end_id)
    pieces = layout(tokens, sequence_tokens, window_tokens, unit_tokens, targets)
    whole = tokens.select("part", "place", "doc_id", "doc_tokens", "ids").join(
        pieces, ["part", "place"]
    )
    return whole.select("doc_id", "doc_tokens", "ids", "pieces").mapInArrow(_cut, PIECE_SCHEMA)


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [zlib.crc32(blob.as_buffer()) for blob in batch.column("ids")]
        columns = [*batch.columns[:-1], pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "ids_crc32"])


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids instead of the ids."""
    return pieces.mapInArrow(_crc, PIECE_SCHEMA.replace("ids binary", "ids_crc32 long"))
