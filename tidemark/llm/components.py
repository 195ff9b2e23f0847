"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that is not the smallest of its component.

    ``links`` has long columns ``a`` and ``b``; loops, repeats and both directions are allowed. Each
    round hooks every node to its smallest smaller neighbour, follows these pointers to their roots by
    doubling, and puts roots for nodes in the links; what is left are links between roots. All steps
    are joins and combining aggregates over stored tables; a node with very many links is combined
    before the shuffle, or split by the join.
    """
    links = stored(_between_roots(links.select("a", "b")), "links")
    found = None
    while not links.isEmpty():
        parents = _roots(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")))
        if found is None:
            found = parents
        else:
            on = parents.select(
                F.col("node").alias("component"), F.col("component").alias("root")
            )
            moved = found.join(on, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")
            )
            found = stored(moved.unionByName(parents), "components")
        for end in ("a", "b"):
            roots = parents.select(F.col("node").alias(end), F.col("component").alias("root"))
            other = "b" if end == "a" else "a"
            links = links.join(roots, end, "left").select(
                other, F.coalesce("root", end).alias(end)
            )
        links = stored(_between_roots(links), "links")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found


def _between_roots(links: DataFrame) -> DataFrame:
    """Distinct links between two nodes, the smaller one first."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.filter("a < b").distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parent pointers (node, component), all to smaller nodes, to their ends."""
    parents = stored(parents, "parents")
    while True:
        above = parents.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = stored(
            parents.join(above, "component", "left").select(
                "node",
                F.coalesce("above", "component").alias("component"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "parents",
        )
        parents = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return parents


def local_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``size`` items over index pairs."""
    root = np.arange(size)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            break
    return root
