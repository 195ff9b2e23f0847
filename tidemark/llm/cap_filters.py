"""Embedding near-dedup with spherical-cap filters from structured random product codes.

Unit vectors are turned by a structured random rotation (signs and Hadamard transforms), cut into
``BLOCKS`` parts, and every part is compared with a random code of ``b`` directions. A filter is one
direction from each part; its score is the sum of the parts' scores. A vector is decoded to the list of
all filters whose score exceeds its best one less ``MARGIN``: combinations are built part by part, and
a partial sum that cannot reach the bound any more is dropped. Vectors that share a filter are compared
by their exact cosine in double precision, a pair in the first filter that both lists have.

Two vectors at cosine 0.98 differ in a filter's score by 0.035 (one standard deviation, for two parts),
so the margin is about three of them and more than one filter is shared as a rule; the tests measure
the recall against brute force (1.0 there, 0.9 is asked for). The size of the code follows from the
number of vectors, so that filters stay small at any size, and nothing is capped: a filter with very
many vectors is cut into blocks, and all pairs of its blocks are compared in tasks of their own.

Equal vectors under one label are one node with a weight; only counts and the links of spanning trees
leave a task.

Defined cases: a null label, and a vector that is null, empty, zero or has null or non-finite parts,
link with nothing; vectors of different lengths do not link; null vec_ids rank last; repeated rows are
counted as rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions_for, row_id, stored
from tidemark.llm.components import components, local_roots

COSINE = 0.98
BLOCKS = 2
MARGIN = 0.11
VECTORS_PER_FILTER = 16
LEAF = 512
SEED = 20240

LISTED = "label long, size int, filter long, node long, weight long, vector binary, filters binary"
LEAVES = (
    "leaf long, label long, size int, first_filter long, last_filter long, rows int,"
    " filter binary, node binary, weight binary, vector binary, filters binary, ends binary"
)
FOUND = "is_link boolean, a long, b long"


def code_size(n: int) -> int:
    """Directions of each part's code: b ** BLOCKS filters for n vectors."""
    wanted = max(1.0, n / VECTORS_PER_FILTER) ** (1 / BLOCKS)
    return min(1 << max(4, math.ceil(math.log2(wanted))), 1 << 14)


class ProductCode:
    """A random rotation and the codes of its parts for vectors of one length."""

    def __init__(self, size: int, b: int):
        rng = np.random.default_rng([SEED, size, b])
        self.b = b
        self.padded = max(BLOCKS, 1 << max(0, (size - 1).bit_length()))
        self.signs = rng.choice([-1.0, 1.0], size=(2, self.padded))
        codes = rng.standard_normal((BLOCKS, b, self.padded // BLOCKS))
        self.codes = codes / np.linalg.norm(codes, axis=2, keepdims=True)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        x = np.pad(x, ((0, 0), (0, self.padded - x.shape[1])))
        for signs in self.signs:
            x = x * signs
            half = 1
            while half < self.padded:
                pairs = x.reshape(len(x), -1, 2, half)
                a, b = pairs[:, :, 0], pairs[:, :, 1]
                x = np.stack([a + b, a - b], axis=2).reshape(len(x), self.padded)
                half *= 2
            x = x / math.sqrt(self.padded)
        return x

    def decode(self, x: np.ndarray, margin: float) -> list[np.ndarray]:
        """The sorted filters of each unit vector."""
        parts = self.rotate(x).reshape(len(x), BLOCKS, -1)
        scores = np.einsum("nkd,kbd->nkb", parts, self.codes)
        best = scores.max(axis=2)
        rest = best.sum(axis=1, keepdims=True) - np.cumsum(best, axis=1)
        out = []
        for k in range(len(x)):
            bound = best[k].sum() - margin
            total, number = np.zeros(1), np.zeros(1, dtype=np.int64)
            for block in range(BLOCKS):
                reach = total[:, None] + scores[k, block][None, :]
                row, column = np.nonzero(reach + rest[k, block] >= bound)
                total, number = reach[row, column], number[row] * self.b + column
            out.append(np.sort(number))
        return out


@lru_cache(maxsize=16)
def _code(size: int, b: int) -> ProductCode:
    return ProductCode(size, b)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, safe for very large and very small components."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _listed(b: int, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy()
            ends = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            sizes = np.diff(ends)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                matrix = flat[ends[rows][:, None] + np.arange(size)]
                lists = _code(int(size), b).decode(unit(matrix), margin)
                owner = np.repeat(rows, [len(x) for x in lists])
                blobs = [v.tobytes() for v in matrix]
                packed = [x.tobytes() for x in lists]
                place = {row: k for k, row in enumerate(rows)}
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").take(take),
                        pa.array(np.full(len(owner), size, dtype="<i4")),
                        pa.array(np.concatenate(lists)),
                        batch.column("node").take(take),
                        batch.column("weight").take(take),
                        pa.array([blobs[place[r]] for r in owner], pa.binary()),
                        pa.array([packed[place[r]] for r in owner], pa.binary()),
                    ],
                    names=[f.split()[0] for f in LISTED.split(", ")],
                )

    return run


def _leaf(rows: pd.DataFrame, number: int) -> dict:
    return {
        "leaf": number,
        "label": rows["label"].iloc[0],
        "size": rows["size"].iloc[0],
        "first_filter": rows["filter"].iloc[0],
        "last_filter": rows["filter"].iloc[-1],
        "rows": len(rows),
        "filter": rows["filter"].to_numpy(np.int64).tobytes(),
        "node": rows["node"].to_numpy(np.int64).tobytes(),
        "weight": rows["weight"].to_numpy(np.int64).tobytes(),
        "vector": b"".join(rows["vector"]),
        "filters": b"".join(rows["filters"]),
        "ends": np.cumsum([len(x) // 8 for x in rows["filters"]]).astype(np.int64).tobytes(),
    }


def _leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut rows sorted by (label, size, filter) into leaves of one label and size, at a filter's end
    where one is near."""
    from pyspark import TaskContext

    part, number, held = TaskContext.get().partitionId(), 0, None

    def cut(rows: pd.DataFrame, final: bool):
        nonlocal number
        group = rows[["label", "size"]].to_numpy()
        filters = rows["filter"].to_numpy()
        other = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
        changes = np.union1d(np.flatnonzero(filters[1:] != filters[:-1]) + 1, other)
        made, start = [], 0
        while start < len(rows) and (final or start + LEAF <= len(rows)):
            end = min(start + LEAF, len(rows))
            early = changes[(changes >= start + LEAF // 2) & (changes <= end)]
            end = early[-1] if len(early) else end
            next_group = other[(other > start) & (other < end)]
            end = next_group[0] if len(next_group) else end
            made.append(_leaf(rows.iloc[start:end], (part << 32) | number))
            number += 1
            start = end
        return made, rows.iloc[start:].reset_index(drop=True)

    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        made, held = cut(held, final=False)
        if made:
            yield pd.DataFrame(made)
    if held is not None and len(held):
        yield pd.DataFrame(cut(held, final=True)[0])


class Leaf:
    """Rows of a leaf as arrays."""

    def __init__(self, row: dict, prefix: str, float_type: str):
        get = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.filter, self.node, self.weight = (get(n, "<i8") for n in ("filter", "node", "weight"))
        self.unit = unit(get("vector", float_type).reshape(len(self.node), -1))
        self.filters, self.ends = get("filters", "<i8"), get("ends", "<i8")

    def lists(self, rows: np.ndarray) -> list[np.ndarray]:
        starts = np.concatenate([[0], self.ends])
        return [self.filters[starts[r] : starts[r + 1]] for r in rows]


def _shares_earlier(left: list, right: list, number: int) -> np.ndarray:
    """Whether two lists share a filter before ``number``."""
    mine, other = ([x[x < number] for x in lists] for lists in (left, right))
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *mine, *other]))
    tables = []
    for lists in (mine, other):
        marks = np.zeros((len(lists), len(known)), dtype=np.float32)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        marks[owner, np.searchsorted(known, np.concatenate([np.zeros(0, np.int64), *lists]))] = 1
        tables.append(marks)
    return tables[0] @ tables[1].T > 0


def _compare(one: Leaf, rows: np.ndarray, other: Leaf, columns: np.ndarray, number: int, least: float):
    """Counts and links between rows of two leaves under one filter; ``one is other`` within a leaf."""
    near = one.unit[rows] @ other.unit[columns].T >= least
    if one is other:
        np.fill_diagonal(near, False)
    if not near.any():
        return []
    i, j = np.nonzero(near)
    own = near & ~_shares_earlier(one.lists(rows), other.lists(columns), number)
    found = [(False, one.node[rows], own @ other.weight[columns])]
    if one is not other:
        found.append((False, other.node[columns], own.T @ one.weight[rows]))
        nodes = np.concatenate([one.node[rows], other.node[columns]])
        root = local_roots(len(nodes), i, j + len(rows))
    else:
        nodes = one.node[rows]
        root = local_roots(len(nodes), i, j)
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    found.append((True, nodes[root[linked]], nodes[linked]))
    return found


def _frames_of(found: list) -> pd.DataFrame:
    parts = [pd.DataFrame({"is_link": link, "a": a, "b": b}) for link, a, b in found]
    frame = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
        {"is_link": pd.Series(dtype=bool), "a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")}
    )
    counts = frame[~frame["is_link"].astype(bool) & (frame["b"] > 0)]
    counts = counts.groupby("a", as_index=False)["b"].sum().assign(is_link=False)
    links = frame[frame["is_link"].astype(bool)].drop_duplicates()
    return pd.concat([counts[["is_link", "a", "b"]], links], ignore_index=True)


def _within(least: float, float_type: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                leaf, found = Leaf(row, "", float_type), []
                for rows in np.split(
                    np.arange(len(leaf.node)), np.flatnonzero(np.diff(leaf.filter)) + 1
                ):
                    if len(rows) > 1:
                        found += _compare(leaf, rows, leaf, rows, leaf.filter[rows[0]], least)
                yield _frames_of(found)

    return run


def _across(least: float, float_type: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                one, other = Leaf(row, "", float_type), Leaf(row, "o_", float_type)
                number = row["shared"]
                rows = np.flatnonzero(one.filter == number)
                columns = np.flatnonzero(other.filter == number)
                yield _frames_of(_compare(one, rows, other, columns, number, least))

    return run


def _nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Numbered rows, and distinct valid vectors (node, label, vector, weight, first)."""
    element = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    rows = vectors.select(
        row_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast(f"array<{kind}>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    rows = stored(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "numbered-vectors")
    first = F.min(F.struct(F.col("vec_id").isNull().alias("unnamed"), F.col("vec_id"), F.col("row")))
    distinct = (
        rows.filter("usable")
        .groupBy("label", "vector")
        .agg(F.count("*").alias("weight"), first.alias("first"))
    )
    numbered = stored(distinct, "distinct-vectors").withColumn("node", row_id())
    return rows, stored(numbered, "vector-nodes"), "<f4" if kind == "float" else "<f8"


def _comparisons(nodes: DataFrame, cosine: float, margin: float, float_type: str) -> DataFrame:
    """Partial link counts (is_link false: node a, count b) and spanning links (a, b)."""
    n = nodes.count()
    listed = nodes.select("label", "node", "weight", "vector").mapInArrow(
        _listed(code_size(n), margin), LISTED
    )
    listed = stored(listed, "filter-lists")
    parts = partitions_for(listed)
    order = ("label", "size", "filter", "node")
    leaves = stored(
        listed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(_leaves, LEAVES),
        "filter-leaves",
    )
    within = leaves.mapInPandas(_within(cosine, float_type), FOUND)
    heads = leaves.select(
        "leaf",
        "label",
        "size",
        F.explode(F.array_distinct(F.array("first_filter", "last_filter"))).alias("shared"),
    )
    others = heads.withColumnRenamed("leaf", "o_leaf")
    pairs = heads.join(others, ["label", "size", "shared"]).filter("leaf < o_leaf")
    content = ["filter", "node", "weight", "vector", "filters", "ends"]
    one = leaves.select("leaf", *content)
    other = leaves.select(
        F.col("leaf").alias("o_leaf"), *(F.col(c).alias(f"o_{c}") for c in content)
    )
    across = (
        pairs.select("leaf", "o_leaf", "shared")
        .join(one, "leaf")
        .join(other, "o_leaf")
        .mapInPandas(_across(cosine, float_type), FOUND)
    )
    return stored(within.unionByName(across), "vector-links")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, margin: float = MARGIN
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of (vec_id, embedding, label)."""
    rows, nodes, float_type = _nodes(vectors)
    found = _comparisons(nodes, cosine, margin, float_type)
    counts = found.filter(~F.col("is_link")).groupBy(F.col("a").alias("node")).agg(
        F.sum("b").alias("near")
    )
    roots = components(found.filter("is_link").select("a", "b"))
    narrow = nodes.select("node", "label", "vector", "weight", "first")
    members = stored(
        narrow.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "label",
            "vector",
            "first",
            (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("root"),
        ),
        "vector-members",
    )
    firsts = members.groupBy("root").agg(F.min("first").alias("keep"))
    keyed = members.join(firsts, "root").select("label", "vector", "n_links", "keep")
    linked = rows.filter("usable").join(keyed, ["label", "vector"]).select(
        "vec_id",
        "n_links",
        F.col("keep.vec_id").alias("component_id"),
        (F.col("keep.row") == F.col("row")).alias("kept"),
    )
    alone = rows.filter(~F.col("usable")).select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return linked.unionByName(alone)
