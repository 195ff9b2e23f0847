"""Sharding by a k-d tree over document metadata with distributed weighted medians.

Points are groups of equal texts, weighted by their bytes. Starting from one node, every node is cut
at the weighted median along its widest dimension, all nodes of a level in the same passes, until a
leaf holds the target bytes. A node for k shards is cut at floor(k / 2) / k of its weight.

Dimensions are scaled to [0, 1]: the logarithm of the length, a hash of the source, a hash of the
language, each of the group's first document. A point's place along a dimension is that number in 20
bits followed by 42 bits of its text's digest, so places are practically distinct and a cut falls
between two groups, also where many documents share a value. The median is found by descending
through the digits of the place: a pass sums the weights of the 4,096 values of the next twelve bits
in every node, and the pass ends when the step at the cut is below ``TOLERANCE`` of a shard, or is one
group. The driver sees 4,096 sums a node at most.

Law: ``bytes``. A group of equal texts stays in one shard unless it is heavier than ``HEAVY`` of a
shard's target; there are at most shards / HEAVY of those, and they are spread over parts of that
weight at most, so that the sizes stay near equal when one text makes a third of the table.

Defined cases: a null text has size 1; null metadata is a value of its own; null and repeated doc_ids
are rows like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_id, stored, text_of

DIMENSIONS = ("by_length", "by_source", "by_lang")
VALUE_BITS = 20
TIE_BITS = 42
DIGIT_BITS = 12
PLACE_BITS = VALUE_BITS + TIE_BITS
HEAVY = 0.02
TOLERANCE = 0.001
ROWS_PER_SLOT_BUCKET = 20_000


@dataclass(frozen=True)
class Node:
    """A leaf so far: its number, its first shard and how many shards it is to hold."""

    number: int
    first: int
    shards: int


def with_metadata(docs: DataFrame) -> DataFrame:
    """row, doc_id, size, text_crc32, digest and metadata of every document; the text is left."""
    text = text_of().cast("binary")
    return docs.select(
        row_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("digest"),
        F.struct(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
        ).alias("about"),
    )


def _hashed(column: str) -> Column:
    """A text value as 20 bits; null is apart."""
    bits = F.pmod(F.xxhash64(F.coalesce(F.col(column), F.lit("\0"))), F.lit(1 << VALUE_BITS))
    return bits.cast("long")


def points(rows: DataFrame, n_shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their salt, and points (digest, salt, weight and a place along each dimension)."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy_bytes = max(HEAVY * total / n_shards, 1.0)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    # sizes sum to the total, so this has n_shards / HEAVY rows at most
    heavy = groups.filter(F.col("group_bytes") > heavy_bytes).select(
        "digest", F.ceil(F.col("group_bytes") / (heavy_bytes / 4)).cast("long").alias("parts")
    )
    salted = rows.join(F.broadcast(heavy), "digest", "left").withColumn(
        "salt",
        F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(
            F.pmod(F.xxhash64("row"), F.col("parts")) + 1
        ),
    )
    about = F.min("about")
    grouped = salted.groupBy("digest", "salt").agg(
        F.sum("size").alias("weight"), F.max("size").alias("size"), about.alias("about")
    )
    length = F.least(F.log2(F.col("size").cast("double")) / 32, F.lit(1.0))
    tie = F.pmod(F.xxhash64("digest", "salt"), F.lit(1 << TIE_BITS)).cast("long")
    tie = F.when(F.col("salt") == 0, tie).otherwise(
        # the parts of a heavy group are neighbours
        F.pmod(F.xxhash64("digest"), F.lit(1 << (TIE_BITS - 20))).cast("long") * (1 << 20)
        + F.pmod(tie, F.lit(1 << 20))
    )
    values = {
        "by_length": F.floor(length * ((1 << VALUE_BITS) - 1)),
        "by_source": _hashed("about.source"),
        "by_lang": _hashed("about.lang"),
    }
    placed = grouped.select(
        "digest",
        "salt",
        "weight",
        *[(value * (1 << TIE_BITS) + tie).alias(name) for name, value in values.items()],
    )
    return salted.drop("parts", "about"), placed


def _widest(tree: DataFrame, nodes: list[Node]) -> dict[int, str]:
    """The dimension of each node with the widest spread of values. One row a node is collected."""
    spans = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
    rows = tree.groupBy("node").agg(*spans).collect()
    found = {row["node"]: max(DIMENSIONS, key=lambda d: row[d] or 0) for row in rows}
    return {node.number: found.get(node.number, DIMENSIONS[0]) for node in nodes}


def _along(dimension: dict[int, str]) -> Column:
    """The place of a point along the dimension of its node."""
    place = F.col(DIMENSIONS[0])
    for number, name in dimension.items():
        place = F.when(F.col("node") == number, F.col(name)).otherwise(place)
    return place


def _cuts(tree: DataFrame, nodes: list[Node], dimension: dict[int, str], fine: float):
    """For each node the place at which the wanted share of its weight lies below."""
    placed = tree.select("node", "weight", _along(dimension).alias("place"))
    open_nodes = {node.number: node for node in nodes}
    low = dict.fromkeys(open_nodes, 0)  # the digits found so far
    below: dict[int, int] = dict.fromkeys(open_nodes, 0)
    wanted: dict[int, float] = {}
    cuts: dict[int, int] = {}
    left = PLACE_BITS
    while open_nodes:
        span = min(left, DIGIT_BITS)
        left -= span
        start_of = F.lit(None).cast("long")
        for number in open_nodes:
            start_of = F.when(F.col("node") == number, F.lit(low[number])).otherwise(start_of)
        behind = F.col("place") - start_of
        sums = (
            placed.withColumn("digit", F.shiftright(behind, left))
            .filter(F.col("digit").between(0, (1 << span) - 1))
            .groupBy("node", "digit")
            .agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
            .collect()
        )
        for number, node in list(open_nodes.items()):
            steps = sorted((r["digit"], r["weight"], r["n"]) for r in sums if r["node"] == number)
            if number not in wanted:
                wanted[number] = sum(w for _, w, _ in steps) * (node.shards // 2) / node.shards
            at = below[number]
            for value, weight, n in steps:
                if at + weight >= wanted[number]:
                    start = low[number] + (value << left)
                    if n == 1 or weight <= fine or left == 0:
                        nearer = at + weight - wanted[number] < wanted[number] - at
                        cuts[number] = start + (1 << left) if nearer else start
                        del open_nodes[number]
                    else:
                        low[number], below[number] = start, at
                    break
                at += weight
            else:
                cuts[number] = 1 << PLACE_BITS
                del open_nodes[number]
    return cuts


def tree_of(placed: DataFrame, n_shards: int) -> DataFrame:
    """Points with their shard."""
    tree = placed.withColumn("node", F.lit(0))
    total = placed.agg(F.sum("weight")).first()[0] or 0
    fine = TOLERANCE * total / n_shards
    nodes = [Node(0, 0, n_shards)]
    while any(node.shards > 1 for node in nodes):
        to_cut = [node for node in nodes if node.shards > 1]
        dimension = _widest(tree, to_cut)
        cuts = _cuts(tree, to_cut, dimension, fine)
        place, node_of = _along(dimension), F.col("node")
        following: list[Node] = []
        for node in nodes:
            half = node.shards // 2
            if not half:
                following.append(Node(node.first, node.first, 1))
                number = F.lit(node.first)
            else:
                following.append(Node(node.first, node.first, half))
                following.append(Node(node.first + half, node.first + half, node.shards - half))
                number = F.when(place < cuts[node.number], F.lit(node.first)).otherwise(
                    F.lit(node.first + half)
                )
            node_of = F.when(F.col("node") == node.number, number).otherwise(node_of)
        # stored, as an expression over all levels would grow with their product
        tree = stored(tree.withColumn("node", node_of.cast("int")), "shard-nodes")
        nodes = following
    return tree.withColumnRenamed("node", "shard")


def _slots(sharded: DataFrame, n_rows: int) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in buckets of bounded size."""
    buckets = max(1, math.ceil(n_rows / ROWS_PER_SLOT_BUCKET))
    bucketed = sharded.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    numbered = bucketed.withColumn("inside", inside - 1)
    return numbered.join(bases, ["shard", "bucket"]).withColumn(
        "slot", F.col("base") + F.col("inside")
    )


def shard(
    docs: DataFrame, n_shards: int | None = 8, target_bytes: int | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    With ``target_bytes`` the number of shards follows from the bytes of the table. ``grown_shard`` is
    null: under the ``bytes`` law a further shard moves rows between all.
    """
    rows = stored(with_metadata(docs), "shard-rows")
    if n_shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, math.ceil(total / target_bytes))
    salted, placed = points(rows, n_shards)
    placed = stored(placed, "shard-points")
    tree = tree_of(placed, n_shards).select("digest", "salt", "shard")
    sharded = stored(
        salted.join(tree, ["digest", "salt"]).select("row", "doc_id", "size", "text_crc32", "shard"),
        "sharded-rows",
    )
    return _slots(sharded, sharded.count()).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
