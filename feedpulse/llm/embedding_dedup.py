"""Near-duplicate embeddings by an inverted multi-index.

The halves of the unit vectors have a codebook each; a pair of codes is a cell
of the product grid, and a vector lives in the cell of its two nearest codes.
A vector visits cells in the order of a lower bound of how far a neighbour must
lie to live there: the distance to the plane between its own code and the
other one, for both halves together. The traversal ends where the bound passes
the radius that the target recall asks for; at a recall of 1, the default, that
is the distance of two vectors at the threshold, and no link can be missed.
Each cell verifies its visitors against its residents in double precision.

Labels don't mix: cells are those of a label. Equal vectors of a label are one
node with a multiplicity, and big cells are dealt in parts of bounded size. A
part hands on numbers of links for each visitor and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.cells import cells
from feedpulse.llm.components import components, forest
from feedpulse.llm.vectors import as_doubles, bounded_sample, matrix, usable
from feedpulse.sources.scratch import stored

SAMPLE = 20_000
#: Vectors that the codebooks' size aims at for a cell, over all labels.
CELL_TARGET = 2_000
MOST_CODES = 256
PART = 2_048
ROUNDS = 15


def codebook(points: np.ndarray, size: int, seed: int = 42) -> np.ndarray:
    """k-means centres, from a fixed start."""
    points = np.unique(points, axis=0)
    if len(points) <= size:
        return points
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), size, replace=False)]
    for _ in range(ROUNDS):
        nearest = distances(points, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=size)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    cross = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.maximum(cross, 0.0)


def margins(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code, and for every code the squared distance to the plane between it and the nearest."""
    d = distances(points, centres)
    nearest = d.argmin(axis=1)
    apart = np.sqrt(distances(centres, centres))[nearest]
    gap = d - d[np.arange(len(points)), nearest][:, None]
    margin = np.divide(gap, 2 * apart, out=np.zeros_like(gap), where=apart > 0)
    return nearest, np.maximum(margin, 0.0) ** 2


def radius(cosine: float, recall: float, width: int) -> float:
    """How far the traversal goes, squared.

    Below a recall of 1, a neighbour is taken to lie in a random direction, so
    that its squared distance across both planes is that of two of ``width``
    components.
    """
    whole = 2 - 2 * cosine
    if recall >= 1:
        return whole + 1e-9
    return min(whole + 1e-9, whole * -2 * math.log(1 - recall) / width)


def visits(nodes: DataFrame, first: np.ndarray, second: np.ndarray, limit: float, width: int) -> DataFrame:
    """(label, i, j, resident, node, vector) for each cell a node visits."""
    half = first.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                x = matrix(part.column("vector"), width)
                own_i, across_i = margins(x[:, :half], first)
                own_j, across_j = margins(x[:, half:], second)
                row, i, j = np.nonzero(across_i[:, :, None] + across_j[:, None, :] <= limit)
                resident = (i == own_i[row]) & (j == own_j[row])
                # A tie of codes leaves every node one home.
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label").take(take), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                        pa.array(resident), part.column("node").take(take), part.column("times").take(take),
                        part.column("vector").take(take),
                    ],
                    names=["label", "i", "j", "resident", "node", "times", "vector"],
                )

    schema = "label string, i int, j int, resident boolean, node long, times long, vector array<double>"
    return nodes.select("label", "node", "times", "vector").mapInArrow(run, schema)


def verified(found: DataFrame, cosine: float, width: int) -> DataFrame:
    """From cells: (a, b) edges of spanning forests, and with null b, (a, n) numbers of links."""

    def compare(table: pa.Table) -> pa.Table:
        home = table.column("resident").to_numpy(zero_copy_only=False)
        node, times = table.column("node").to_numpy(), table.column("times").to_numpy()
        x = matrix(table.column("vector"), width)
        nodes, at = np.unique(node, return_inverse=True)
        a, b = at[home], at[~home]
        left, right, links = [np.empty(0, int)], [np.empty(0, int)], np.zeros(len(b), dtype=np.int64)
        for k in range(0, len(b), 512):
            near = x[~home][k : k + 512] @ x[home].T >= cosine
            v, r = np.nonzero(near)
            keep = b[k + v] != a[r]
            v, r = v[keep], r[keep]
            links[k : k + 512] += np.bincount(v, times[home][r], minlength=len(links[k : k + 512])).astype(np.int64)
            left.append(b[k + v])
            right.append(a[r])
        label = forest(np.concatenate(left), np.concatenate(right), len(nodes))
        hung = np.flatnonzero(label != np.arange(len(nodes)))
        some = links > 0
        empty = lambda n: pa.nulls(n, pa.int64())
        return pa.table(
            {
                "a": pa.concat_arrays([pa.array(nodes[hung]), pa.array(node[~home][some])]),
                "b": pa.concat_arrays([pa.array(nodes[label[hung]]), empty(int(some.sum()))]),
                "n": pa.concat_arrays([empty(len(hung)), pa.array(links[some])]),
            }
        )

    return found.groupBy("label", "i", "j", "r", "v").applyInArrow(compare, "a long, b long, n long")


def near_duplicates(
    rows: DataFrame,
    cosine: float = 0.98,
    recall: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Key, n_links, component_id, kept for every row of ``rows``.

    Rows with a null label, or an unusable vector (null, zero, or with components
    that are null or not finite), have no links and are their own component. A
    row with a null key is linked like others but names no component; where no row has one,
    the component is null. Repeated rows are vectors of their own, linked with
    each other. Vectors shorter than the longest are filled with zeros. Other
    columns are left out; an empty table gives an empty result.
    """
    own = rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("string").alias("label"), as_doubles(vector).alias("vector")
    )
    own = own.withColumn("able", usable("vector") & F.col("label").isNotNull())
    # Two independent hashes name a vector and its label.
    own = own.withColumn("h1", F.xxhash64("vector", "label")).withColumn("h2", F.xxhash64(F.lit(1), "label", "vector"))
    grouped = (
        own.where("able")
        .groupBy("label", "h1", "h2")
        .agg(F.min("key").alias("least"), F.count("*").alias("times"), F.first("vector").alias("vector"))
    )
    square = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.expr("transform(vector, x -> x / norm)")
    nodes = grouped.withColumn("norm", square).withColumn("vector", unit).drop("norm")
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    width, n = nodes.agg(F.max(F.size("vector")), F.count("*")).first()
    result = own.select("key", "able", "h1", "h2", "label")
    if not n:
        known = result.withColumn("links", F.lit(0)).withColumn("root", F.col("key"))
        return _named(known, key)
    codes = min(MOST_CODES, max(1, math.ceil(math.sqrt(n / CELL_TARGET))))
    sample = bounded_sample(nodes, "h1", "vector", SAMPLE, width)
    half = (width + 1) // 2
    first, second = codebook(sample[:, :half], codes), codebook(sample[:, half:], codes)
    found = cells(
        visits(nodes, first, second, radius(cosine, recall, width), width), ["label", "i", "j"], "node", PART
    )
    links = stored(verified(found, cosine, width), "links")
    roots = components(links.where("b IS NOT NULL").select("a", "b"))
    numbers = links.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    rooted = (
        nodes.select("node", "h1", "h2", "label", "least", "times")
        .join(roots, "node", "left")
        .join(numbers, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("of_root"))
    named = rooted.join(least, "root").select(
        "h1", "h2", "label", F.col("of_root"), (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("links")
    )
    linked = result.where("able").join(named, ["h1", "h2", "label"]).select("key", "links", F.col("of_root").alias("root"))
    alone = result.where("NOT able").select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("root"))
    return _named(linked.unionByName(alone), key)


def _named(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(
        F.col("key").alias(key),
        F.col("links").cast("long").alias("n_links"),
        F.col("root").alias("component_id"),
        F.col("key").eqNullSafe(F.col("root")).alias("kept"),
    )
