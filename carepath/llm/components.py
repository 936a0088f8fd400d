"""Connected components of a graph given as edges, and of small graphs in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of the nodes 0..n-1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != (jump := new[new])).any():
            new = jump
        if (new == root).all():
            return root
        root = new


def _link(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours hang themselves on the smallest neighbour.

    Large: both directions, only larger neighbours move. Small: edges from larger to smaller.
    Minima are combined before the exchange; the join has one row per node on one side, so
    a node with very many neighbours is split by adaptive execution.
    """
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        moved = both.where("v > u").join(low, F.col("u") == F.col("n"))
        out = moved.select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    else:
        low = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        moved = edges.join(low, F.col("a") == F.col("n"))
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        out = out.union(low.select("n", "m"))
    return out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest of its component.

    Alternating star steps; each round is written to the shared folder, so a lost executor
    costs one round at most. The number of rounds grows with the logarithm of the longest
    chain. Loops and repeated edges do no harm; no edges give no rows.
    """
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = stage(state, "links")
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select("b", "b").distinct()
            )
        before = mark
        state = stage(_link(_link(state, large=True), large=False), "links")
