"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.sources.scratch import stored

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; ``edges`` has longs ``a`` and ``b``.

    Large-star and small-star steps in turn: each hangs a node's neighbours on the
    smallest of them, until all hang on their component's smallest node. A round
    is stored in the shared scratch folder, so that a lost executor costs only
    the round. Rows stay within twice the edges.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = None
    for _ in range(ROUNDS):
        after = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before or not after[0]:
            break
        before = after
        current = stored(_small_star(_large_star(current)), "edges")
    else:
        raise RuntimeError("the components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 with edges (a, b): the smallest node each is connected with."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
