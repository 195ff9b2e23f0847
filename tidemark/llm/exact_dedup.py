"""Exact dedup by minimal perfect hashing over the distinct digests already seen.

``build_index`` takes the distinct digests with their winners and gives every one a slot of its own:
digests are dealt to buckets by their first bytes; in a bucket of n digests a displacement for each
small group of them (hash, displace and compress) makes slot numbers 0 to n-1 with no gap. Group and
hashes come from XXH64 of the digest under the try's seed, so every try deals the digests anew; a bucket
that no seed fits keeps its sorted digests, whose places are the slots. The index
is two tables: the displacements of each bucket, and the slots with the full digest and the winner's
locator. ``lookup`` turns a row's digest into a slot with arithmetic in the JVM, and compares all 32
bytes with the slot's: rows whose digest is there are repeats of its winner, the others are not
members and are grouped separately.

Texts are equal when they are identical after the white space in ``ASCII_SPACE`` is deleted. Of equal
texts the one with the most code points stays, then the smallest doc_id, then the first row.

Defined cases: a null text counts as empty, so empty texts are one group; null doc_ids rank last; of
rows that agree in everything one stays; an empty table gives no rows; other columns are ignored here
and kept by ``keep_winners``; a very long text is hashed whole, in memory once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, quoted, row_id, stored, text_of, with_row_numbers

KEYS_PER_BUCKET = 256
KEYS_PER_GROUP = 4
MAX_SEEDS = 1000


def with_digests(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """row, doc_id, text_sha256 of the normalised text, and n_points of the original."""
    return docs.select(
        (row_id() if row is None else row).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.translate(text_of(), ASCII_SPACE, ""), 256).alias("text_sha256"),
        F.length(text_of()).cast("long").alias("n_points"),
    )


def winners(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each distinct digest (or other keys): group_size, and the doc_id and row that stay."""
    keys = keys or ("text_sha256",)
    best = F.min(
        F.struct(
            (-F.col("n_points")).alias("shorter"),
            F.col("doc_id").isNull().alias("unnamed"),
            F.col("doc_id"),
            F.col("row"),
        )
    )
    return (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .select(
            *keys,
            "group_size",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
        )
    )


def _word(digest: Column, k: int) -> Column:
    """The k-th 32-bit word of a hex digest, as a long."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def bucket_of(digest: Column, n_buckets: int) -> Column:
    return F.pmod(_word(digest, 0), F.lit(n_buckets).cast("long"))


def _hashes(digests: list[str], seed: int) -> np.ndarray:
    """Spark's ``xxhash64(seed, digest)`` of each digest."""
    start = xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), 42)
    values = [xxhash.xxh64_intdigest(d.encode(), start) for d in digests]
    return np.array(values, dtype=np.uint64)


def _parts(hashed: np.ndarray) -> list[np.ndarray]:
    """Three numbers of 21, 21 and 22 bits."""
    low = np.uint64((1 << 21) - 1)
    parts = [hashed & low, (hashed >> np.uint64(21)) & low, hashed >> np.uint64(42)]
    return [part.astype(np.int64) for part in parts]


def _parts_of(hashed: Column) -> list[Column]:
    """The same of a column."""
    low = F.lit((1 << 21) - 1).cast("long")
    return [
        hashed.bitwiseAND(low),
        F.shiftrightunsigned(hashed, 21).bitwiseAND(low),
        F.shiftrightunsigned(hashed, 42),
    ]


def place(parts: list, n_keys, n_groups) -> tuple:
    """Group number and the two hashes of a key; the same arithmetic on columns and arrays."""
    return parts[0] % n_groups, parts[1] % n_keys, parts[2] % n_keys


def _displace(digests: list[str], seed: int) -> np.ndarray | None:
    """Displacements d for the groups such that (first + d / n * second + d % n) % n are all slots."""
    n = len(digests)
    n_groups = -(-n // KEYS_PER_GROUP)
    group, first, second = place(_parts(_hashes(digests, seed)), n, n_groups)
    free = np.ones(n, dtype=bool)
    shifts = np.arange(n)
    found = np.zeros(n_groups, dtype=np.int64)
    sizes = np.bincount(group, minlength=n_groups)
    for g in np.argsort(-sizes, kind="stable"):
        members = np.flatnonzero(group == g)
        if not len(members):
            break
        for step in range(n):
            at = (first[members] + step * second[members]) % n
            if len(np.unique(at)) < len(at):
                continue
            slots = (at[:, None] + shifts[None, :]) % n
            fits = np.flatnonzero(free[slots].all(axis=0))
            if len(fits):
                found[g] = step * n + fits[0]
                free[slots[:, fits[0]]] = False
                break
        else:
            return None
    return found


def _build_bucket(keys: pd.DataFrame, max_seeds: int = MAX_SEEDS) -> pd.DataFrame:
    """Seed and displacements of a bucket, or its sorted digests where no seed fits."""
    digests = sorted(keys["text_sha256"])
    if len(set(digests)) < len(digests):
        raise ValueError("the digests of an index must be distinct")
    tries = ((seed, _displace(digests, seed)) for seed in range(max_seeds))
    seed, found = next((t for t in tries if t[1] is not None), (None, None))
    return pd.DataFrame(
        {
            "bucket": [keys["bucket"].iloc[0]],
            "seed": pd.array([seed], dtype="Int64"),
            "n_keys": [len(digests)],
            "shifts": [None if found is None else found.tolist()],
            "digests": [digests if found is None else None],
        }
    )


def _slot(digest: Column) -> Column:
    """The slot of a digest; one that a bucket of sorted digests has not gets -1."""
    n_keys, n_groups = F.col("n_keys"), F.size("shifts").cast("long")
    hashed = _parts_of(F.xxhash64(F.col("seed"), digest))
    group, first, second = place(hashed, n_keys, n_groups)
    shift = F.get("shifts", group.cast("int"))
    slot = F.pmod(first + F.floor(shift / n_keys) * second + F.pmod(shift, n_keys), n_keys)
    plain = F.array_position("digests", digest).cast("long") - 1
    return F.when(F.col("shifts").isNotNull(), slot).otherwise(plain)


def build_index(
    groups: DataFrame, label: str = "digest-index", max_seeds: int = MAX_SEEDS
) -> tuple[DataFrame, DataFrame, int]:
    """The index over distinct digests: displacements by bucket, slots, and the bucket count.

    Buckets hold about ``KEYS_PER_BUCKET`` distinct digests each at any size, as SHA-256 spreads
    them; a digest that a third of all rows share is one key here.
    """
    n_buckets = max(1, -(-groups.count() // KEYS_PER_BUCKET))
    keyed = groups.withColumn("bucket", bucket_of(F.col("text_sha256"), n_buckets))
    functions = stored(
        keyed.select("bucket", "text_sha256")
        .groupBy("bucket")
        .applyInPandas(
            lambda keys: _build_bucket(keys, max_seeds),
            "bucket long, seed long, n_keys long, shifts array<long>, digests array<string>",
        ),
        f"{label}-functions",
    )
    slots = (
        keyed.join(functions, "bucket")
        .withColumn("slot", _slot(F.col("text_sha256")))
        .select(
            "bucket",
            "slot",
            F.col("text_sha256").alias("slot_sha256"),
            "group_size",
            "keep_id",
            "keep_row",
        )
    )
    return functions, stored(slots, f"{label}-slots"), n_buckets


def lookup(rows: DataFrame, index: tuple[DataFrame, DataFrame, int]) -> DataFrame:
    """Rows with their slot, and the winner of their digest where the index has it, else nulls.

    Both joins have plain shuffles on their sides, so a bucket that a hot digest fills is split.
    """
    functions, slots, n_buckets = index
    digest = F.col("text_sha256")
    numbered = (
        rows.withColumn("bucket", bucket_of(digest, n_buckets))
        .join(functions, "bucket", "left")
        .withColumn("slot", _slot(digest))
        .drop("seed", "n_keys", "shifts", "digests")
    )
    found = numbered.join(slots, ["bucket", "slot"], "left")
    same = F.col("slot_sha256") == digest
    for name in ("group_size", "keep_id", "keep_row"):
        found = found.withColumn(name, F.when(same, F.col(name)))
    return found.withColumn("member", F.coalesce(same, F.lit(False))).drop("slot_sha256")


def in_history(row: Column) -> Column:
    """The rows whose distinct digests are indexed: those with an even hash of their number, a half."""
    return F.pmod(F.xxhash64(row), F.lit(2)) == 0


def exact_dedup(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """One row for each document: row, doc_id, keep_id, group_size, kept, text_sha256.

    Half of the rows are the history, whose distinct digests the index holds. All rows are looked up:
    members are grouped by their slot, and the others, of whose texts no copy is in the history, by
    their digest, on their own. A large group of copies is certain to be in the history, so groups of
    nonmembers stay small. The winners are stored, so that the rows of a large group are split over
    tasks when they are joined with theirs.
    """
    rows = stored(with_digests(docs, row), "digests")
    history = stored(winners(rows.filter(in_history(F.col("row")))), "history-digests")
    found = lookup(rows, build_index(history)).drop("group_size", "keep_id", "keep_row")
    looked = stored(found, "looked-up")
    parts = []
    for members, keys in ((True, ("bucket", "slot")), (False, ("text_sha256",))):
        part = looked.filter(F.col("member") == members)
        parts.append(part.join(stored(winners(part, *keys), "digest-winners"), list(keys)))
    return parts[0].unionByName(parts[1]).select(
        "row",
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("keep_row") == F.col("row")).alias("kept"),
        "text_sha256",
    )


def remove_seen(docs: DataFrame, index: tuple[DataFrame, DataFrame, int]) -> DataFrame:
    """A later delivery against an index: (row, doc_id, keep_id, group_size, kept, text_sha256).

    Members repeat the indexed winner and go; the others are grouped among themselves.
    """
    looked = stored(lookup(stored(with_digests(docs), "digests"), index), "looked-up")
    columns = ["row", "doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    seen = looked.filter("member").withColumn("kept", F.lit(False)).select(columns)
    new = looked.filter(~F.col("member")).drop("group_size", "keep_id", "keep_row", "bucket", "slot")
    grouped = new.join(winners(new), "text_sha256")
    return seen.unionByName(
        grouped.withColumn("kept", F.col("keep_row") == F.col("row")).select(columns)
    )


def keep_winners(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that repeat another; columns unchanged.

    The rows are numbered once and stored with their numbers; decision and result read that table.
    """
    numbered, number = with_row_numbers(docs)
    dropped = exact_dedup(numbered, F.col(number)).filter(~F.col("kept"))
    dropped = dropped.select(F.col("row").alias(number))
    return numbered.join(dropped, number, "left_anti").select(*map(quoted, docs.columns))
