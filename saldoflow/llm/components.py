"""Connected components of a graph given as links, wholly by joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from saldoflow.session import shared_folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder, which outlives executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node in a link.

    Alternates two rewirings until nothing changes: every node's larger neighbours
    are tied to its smallest one, then its smaller neighbours and itself are. Links
    never grow in number and the rounds are logarithmic in practice. The smallest
    neighbour is an aggregate that combines before its shuffle and is checkpointed,
    so that the join with a node that has very many links can be split.
    """
    now = cut(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(both.filter(F.col("v") > F.col("u")).join(least, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        tied = large.join(least, "u").filter(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(links: DataFrame) -> tuple:
    """A count and an order-free hash of all links; equal if nothing has changed."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n items over the links (i, j); for one task."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
