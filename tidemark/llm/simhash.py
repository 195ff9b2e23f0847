"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, in which neighbours differ in few bits, and cut into leaves of
consecutive fingerprints. Each node of the index (32 fingerprints, then a leaf) is described by the
bits that all below it share, a mask and a pattern. A search adds up the differences of two nodes
under both masks and leaves out the whole pair of groups once they exceed the limit; what is left is
compared one level lower, and at last bit by bit.

To keep the search within leaves, the index is built for several orders of the bits. The 64 bits are
cut into ``limit + m`` blocks; two fingerprints that differ in at most ``limit`` bits agree in m whole
blocks, so in one of the C(limit + m, m) orders that put m blocks first they lie in one run of equal
leading bits. m follows from the number of distinct fingerprints such that a run of evenly spread
fingerprints fits a leaf. A run longer than a leaf, which near copies can make at any m, spans several leaves; all pairs of
its leaves that the masks do not rule out are searched. Nothing is capped: every link is found.

Only links of a spanning tree leave a leaf, then components are formed over distinct fingerprints.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, linked like any
other; exact copies share a fingerprint and are one node; null doc_ids rank last and give a null
component only if all members have none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    ASCII_UPPER,
    bounded_batches,
    partitions_for,
    quoted,
    row_id,
    stored,
    text_of,
    with_row_numbers,
)
from tidemark.llm.components import components, local_roots

BITS = 64
LIMIT = 4
SHINGLE_WORDS = 4
HASH_SEED = 42
LEAF = 1024
NODE = 32
HASHES_AT_ONCE = 1 << 18

_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_UPPER.lower().encode())


def _spans(text: bytes, width: int) -> tuple[bytes, list[int], list[int]]:
    """The joined words of a text, and where its shingles start and end."""
    words = text.translate(_LOWER).split()
    if not words:
        return b"", [], []
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return joined, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """The XXH64 hashes of the word shingles of a UTF-8 text, repeats included."""
    joined, first, last = _spans(text, width)
    hashed = xxhash.xxh64_intdigest
    values = (hashed(joined[a:b], HASH_SEED) for a, b in zip(first, last, strict=True))
    return np.fromiter(values, dtype=np.uint64, count=len(first))


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text over XXH64 hashes of its word shingles, repeats included."""
    joined, first, last = _spans(text, width)
    if not first:
        return 0
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(first), HASHES_AT_ONCE):
        spans = zip(first[k : k + HASHES_AT_ONCE], last[k : k + HASHES_AT_ONCE], strict=True)
        hashes = b"".join([digest(joined[a:b], HASH_SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            values = [fingerprint(text.as_buffer().to_pybytes(), width) for text in texts]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(signed)],
                names=["row", "doc_id", "fp"],
            )

    return run


def with_fingerprints(
    docs: DataFrame, width: int = SHINGLE_WORDS, row: Column | None = None
) -> DataFrame:
    """row, doc_id and the fingerprint as a signed long."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        (row_id() if row is None else row).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().cast("binary").alias("text"),
    )
    return rows.mapInArrow(_fingerprints(width), "row long, doc_id long, fp long")


def orders_for(n: int, limit: int = LIMIT) -> tuple[list[tuple[int, ...]], list[np.ndarray]]:
    """The block orders: which blocks lead in each, and the bit positions of all blocks."""
    m = 1
    while n >> (m * (BITS // (limit + m))) > LEAF // 2 and m < limit + 4:
        m += 1
    blocks = np.array_split(np.arange(BITS), limit + m)
    return list(combinations(range(limit + m), m)), blocks


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order of the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def reordered(codes: np.ndarray, leading: tuple[int, ...], blocks: list[np.ndarray]) -> np.ndarray:
    """The codes with the bits of the leading blocks first."""
    out = np.zeros_like(codes)
    rest = [b for b in range(len(blocks)) if b not in leading]
    for b in (*leading, *rest):
        width = np.uint64(len(blocks[b]))
        shift = np.uint64(BITS - 1 - blocks[b][-1])
        part = (codes >> shift) & np.uint64((1 << int(width)) - 1)
        out = (out << width) | part
    return out


def _ranked(limit: int, n: int):
    leading, blocks = orders_for(n, limit)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            codes = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for k, lead in enumerate(leading):
                rank = gray_rank(reordered(codes, lead, blocks))
                lead_bits = np.uint64(BITS - sum(len(blocks[b]) for b in lead))
                yield pd.DataFrame(
                    {
                        "view": np.full(len(codes), k, dtype=np.int32),
                        # as signed numbers in the same order
                        "rank": (rank ^ np.uint64(1 << 63)).view(np.int64),
                        "run": (rank >> lead_bits).view(np.int64),
                        "fp": codes.view(np.int64),
                    }
                )

    return run


def shared_bits(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of each node of ``NODE`` consecutive codes."""
    starts = np.arange(0, len(codes), NODE)
    patterns = codes[starts]
    varying = np.bitwise_or.reduceat(codes ^ np.repeat(patterns, NODE)[: len(codes)], starts)
    return ~varying, patterns


def search(a: np.ndarray, b: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with at most ``limit`` differing bits between a[i] and b[j].

    ``a`` and ``b`` are sorted by Gray rank; groups are left out level by level.
    """
    mask_a, pattern_a = shared_bits(a)
    mask_b, pattern_b = shared_bits(b)
    apart = np.bitwise_count(
        (pattern_a[:, None] ^ pattern_b) & mask_a[:, None] & mask_b
    )
    upper, lower = np.nonzero(apart <= limit)
    i = (upper[:, None] * NODE + np.arange(NODE)).ravel()
    node = np.repeat(lower, NODE)
    inside = i < len(a)
    i, node = i[inside], node[inside]
    near = np.bitwise_count((a[i] ^ pattern_b[node]) & mask_b[node]) <= limit
    i, node = i[near], node[near]
    left, right = [], []
    for start in range(0, len(i), 1 << 15):
        part, at = i[start : start + (1 << 15)], node[start : start + (1 << 15)]
        j = at[:, None] * NODE + np.arange(NODE)
        inside = j < len(b)
        hits = inside & (
            np.bitwise_count(a[part][:, None] ^ b[np.where(inside, j, 0)]) <= limit
        )
        row, column = np.nonzero(hits)
        left.append(part[row])
        right.append(j[row, column])
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _spanning(codes: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    root = local_roots(len(codes), left, right)
    linked = np.flatnonzero(root != np.arange(len(codes)))
    signed = codes.view(np.int64)
    return pd.DataFrame({"a": signed[root[linked]], "b": signed[linked]})


def _leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut sorted rows into leaves; close one at the end of a run when it is three quarters full."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        leaves, held = _cut_leaves(held, final=False)
        for leaf in leaves:
            yield _leaf_row(leaf, (part << 32) | number)
            number += 1
    if held is not None:
        for leaf in _cut_leaves(held, final=True)[0]:
            yield _leaf_row(leaf, (part << 32) | number)
            number += 1


def _cut_leaves(rows: pd.DataFrame, final: bool) -> tuple[list[pd.DataFrame], pd.DataFrame | None]:
    view, run = rows["view"].to_numpy(), rows["run"].to_numpy()
    changes = np.flatnonzero((view[1:] != view[:-1]) | (run[1:] != run[:-1])) + 1
    view_changes = np.flatnonzero(view[1:] != view[:-1]) + 1
    leaves, start = [], 0
    while start < len(rows):
        end = start + LEAF
        if end > len(rows) and not final:
            break
        end = min(end, len(rows))
        early = changes[(changes >= start + LEAF * 3 // 4) & (changes <= end)]
        if len(early):
            end = early[-1]
        other = view_changes[(view_changes > start) & (view_changes < end)]
        if len(other):
            end = other[0]
        leaves.append(rows.iloc[start:end])
        start = end
    return leaves, rows.iloc[start:].reset_index(drop=True) if start < len(rows) else None


def _leaf_row(rows: pd.DataFrame, leaf: int) -> pd.DataFrame:
    codes = rows["fp"].to_numpy(np.int64).view(np.uint64)
    varying = np.bitwise_or.reduce(codes ^ codes[0])
    return pd.DataFrame(
        {
            "leaf": [leaf],
            "view": [rows["view"].iloc[0]],
            "first_run": [rows["run"].iloc[0]],
            "last_run": [rows["run"].iloc[-1]],
            "mask": (~varying).reshape(1).view(np.int64),
            "pattern": codes[:1].view(np.int64),
            "codes": [codes.tobytes()],
        }
    )


def _search_leaves(limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for blob in frame["codes"]:
                codes = np.frombuffer(blob, dtype=np.uint64)
                i, j = search(codes, codes, limit)
                yield _spanning(codes, i[i < j], j[i < j])

    return run


def _search_pairs(limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for one, other in zip(frame["codes"], frame["other_codes"], strict=True):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                i, j = search(a, b, limit)
                yield _spanning(np.concatenate([a, b]), i, j + len(a))

    return run


def fingerprint_links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` within ``limit`` differing bits."""
    n = distinct.count()
    ranked = distinct.select("fp").mapInPandas(
        _ranked(limit, n), "view int, rank long, run long, fp long"
    )
    views = math.comb(len(orders_for(n, limit)[1]), limit)
    parts = max(partitions_for(distinct), -(-n * views // 1_000_000))
    ordered = ranked.repartitionByRange(parts, "view", "rank").sortWithinPartitions("view", "rank")
    leaves = stored(
        ordered.mapInPandas(
            _leaves,
            "leaf long, view int, first_run long, last_run long, mask long, pattern long,"
            " codes binary",
        ),
        "simhash-leaves",
    )
    within = leaves.select("codes").mapInPandas(_search_leaves(limit), "a long, b long")
    runs = leaves.select(
        "leaf",
        "view",
        "mask",
        "pattern",
        F.explode(F.array_distinct(F.array("first_run", "last_run"))).alias("run"),
    )
    other = runs.select(
        "view",
        "run",
        F.col("leaf").alias("other"),
        F.col("mask").alias("other_mask"),
        F.col("pattern").alias("other_pattern"),
    )
    apart = F.bit_count(
        F.col("pattern")
        .bitwiseXOR(F.col("other_pattern"))
        .bitwiseAND(F.col("mask"))
        .bitwiseAND(F.col("other_mask"))
    )
    pairs = (
        runs.join(other, ["view", "run"])
        .filter((F.col("leaf") < F.col("other")) & (apart <= limit))
        .select("leaf", "other")
        .distinct()
    )
    across = (
        pairs.join(leaves.select("leaf", "codes"), "leaf")
        .join(
            leaves.select(F.col("leaf").alias("other"), F.col("codes").alias("other_codes")),
            "other",
        )
        .select("codes", "other_codes")
        .mapInPandas(_search_pairs(limit), "a long, b long")
    )
    return within.unionByName(across)


def near_rows(
    docs: DataFrame, limit: int = LIMIT, width: int = SHINGLE_WORDS, row: Column | None = None
) -> DataFrame:
    """row, doc_id and fp of each document, and the (unnamed, doc_id, row) that its component keeps."""
    rows = stored(with_fingerprints(docs, width, row), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("row")))
    distinct = stored(rows.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(fingerprint_links(distinct, limit))
    members = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    members = stored(members, "fingerprint-roots")
    firsts = members.groupBy("root").agg(F.min("first").alias("keep"))
    by_code = members.join(firsts, "root").select("fp", "keep")
    return rows.join(by_code, "fp")


def near_groups(
    docs: DataFrame, limit: int = LIMIT, width: int = SHINGLE_WORDS, row: Column | None = None
) -> DataFrame:
    """One row a document: row, doc_id, fingerprint, component_id, kept.

    The member with the smallest doc_id of each component is kept.
    """
    return near_rows(docs, limit, width, row).select(
        "row",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("keep.doc_id").alias("component_id"),
        (F.col("keep.row") == F.col("row")).alias("kept"),
    )


def keep_firsts(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` with one document of each group of near copies; columns unchanged.

    The rows are numbered once and stored with their numbers; decision and result read that table.
    """
    numbered, number = with_row_numbers(docs)
    dropped = near_groups(numbered, limit, row=F.col(number)).filter(~F.col("kept"))
    dropped = dropped.select(F.col("row").alias(number))
    return numbered.join(dropped, number, "left_anti").select(*map(quoted, docs.columns))
