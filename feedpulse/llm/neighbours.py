"""Nearest neighbours by stable projections and kd-trees.

The largest inner product is the smallest Euclidean distance once vectors get
one more component: scaled by the largest norm, they are filled up to norm 1,
and queries are scaled to norm 1 with 0 there. A few 2-stable (Gaussian)
projections make points of low dimension, whose squared distance over the true one follows a
chi-square distribution. A kd-tree fitted on a bounded sample deals all points
to cells; every cell has a kd-tree of its own.

A query starts in its own cell, which bounds the distance of its k-th
neighbour. Then it visits what may hold nearer ones: the cells, and in them the
leaves, in the order of projected distance. Their vectors are verified by the
exact inner product. It stops where the next leaf's projected distance is so
large against the k-th true distance that a chi-square test gives any true
neighbour beyond it less than 1 - ``confidence``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedpulse.llm.vectors import as_doubles, matrix, usable
from feedpulse.sources.scratch import stored

PROJECTIONS = 12
CONFIDENCE = 0.97
SAMPLE = 20_000
CELL = 8_192
DEEPEST = 12
LEAF = 64
QUERIES = 8_192
#: Scores closer than this count as equal until they are computed anew, term by term.
CLOSE = 1e-12


def chi_square_quantile(p: float, dof: int) -> float:
    """For an even number of degrees of freedom."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, dof // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 10.0 * dof + 200
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Tree:
    """A kd-tree of fixed depth over projected points; cells are numbered from left to right."""

    def __init__(self, points: np.ndarray, depth: int) -> None:
        self.depth, m = depth, points.shape[1]
        self.axis, self.value = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
        self.low = np.full((1 << depth, m), -np.inf)
        self.high = np.full((1 << depth, m), np.inf)
        self._split(points, 1, 0, self.low[0].copy(), self.high[0].copy())

    def _split(self, points: np.ndarray, node: int, level: int, low: np.ndarray, high: np.ndarray) -> None:
        if level == self.depth:
            self.low[node - (1 << level)], self.high[node - (1 << level)] = low, high
            return
        axis = int(np.ptp(points, axis=0).argmax()) if len(points) else 0
        value = float(np.median(points[:, axis])) if len(points) else 0.0
        self.axis[node], self.value[node] = axis, value
        left = points[:, axis] <= value
        upper, lower = high.copy(), low.copy()
        upper[axis], lower[axis] = min(high[axis], value), max(low[axis], value)
        self._split(points[left], 2 * node, level + 1, low, upper)
        self._split(points[~left], 2 * node + 1, level + 1, lower, high)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] > self.value[node]
            node = 2 * node + right
        return node - (1 << self.depth)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis][:, None]
        out += np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0.0) ** 2
    return out


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """The points' numbers, in the leaves of a kd-tree split at medians."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        own = open_.pop()
        if len(own) <= size:
            done.append(own)
            continue
        axis = int(np.ptp(points[own], axis=0).argmax())
        order = own[np.argsort(points[own, axis], kind="stable")]
        open_ += [order[: len(own) // 2], order[len(own) // 2 :]]
    return [np.sort(x) for x in done if len(x)]


class Space:
    """The projection, the largest norm and the cells; small, and sent to the executors as it is."""

    def __init__(self, width: int, largest: float, projections: int, confidence: float, seed: int) -> None:
        self.width, self.largest = width, largest
        self.plane = np.random.default_rng(seed).standard_normal((width + 1, projections))
        self.stop = chi_square_quantile(confidence, projections)
        self.tree: Tree | None = None

    def points(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1)))
        return scaled @ self.plane[:-1] + rest[:, None] * self.plane[-1]

    def query_points(self, vectors: np.ndarray) -> np.ndarray:
        return vectors / np.linalg.norm(vectors, axis=1)[:, None] @ self.plane[:-1]

    def distance(self, scores: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared distances of filled-up vectors with these inner products."""
        return np.maximum(0.0, 2 - 2 * scores / (norms * self.largest))

    def search(self, base_ids, base, query_ids, queries, bound, k):
        """The k best of a cell for each query: (query's number, base's number, exact score).

        ``bound``: the k-th best inner product so far, minus infinity if there are fewer.
        """
        order = np.argsort(base_ids, kind="stable")
        base_ids, base = base_ids[order], base[order]
        points, places = self.points(base), self.query_points(queries)
        tree = leaves(points)
        low = np.array([points[x].min(axis=0) for x in tree])
        high = np.array([points[x].max(axis=0) for x in tree])
        away = box_distances(places, low, high)
        turn = np.argsort(away, axis=1, kind="stable")
        norms = np.linalg.norm(queries, axis=1)
        best = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), len(base), dtype=np.int64)
        going = np.arange(len(queries))
        for step in range(len(tree)):
            leaf = turn[going, step]
            least = np.maximum(best[going, -1], bound[going])
            reach = self.distance(least, norms[going]) * self.stop
            near = (away[going, leaf] <= reach) | np.isneginf(least)
            going, leaf = going[near], leaf[near]
            if not len(going):
                break
            sort = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.diff(leaf[sort])) + 1
            for group in np.split(sort, cuts):
                who, own = going[group], tree[leaf[group[0]]]
                scores = queries[who] @ base[own].T
                scores[query_ids[who][:, None] == base_ids[own][None, :]] = -np.inf
                better = scores.max(axis=1) >= np.maximum(best[who, -1], bound[who]) - CLOSE
                if not better.any():
                    continue
                who, scores = who[better], scores[better]
                value = np.concatenate([best[who], scores], axis=1)
                number = np.concatenate([found[who], np.broadcast_to(own, scores.shape)], axis=1)
                number = np.where(np.isneginf(value), len(base), number)
                first = np.lexsort((number, -np.round(value, 12)), axis=1)[:, :k]
                best[who] = np.take_along_axis(value, first, axis=1)
                found[who] = np.take_along_axis(number, first, axis=1)
        q, place = np.nonzero(found < len(base))
        b = found[q, place]
        # Each score by itself, so that equal vectors get equal scores.
        exact = (queries[q] * base[b]).sum(axis=1)
        return q, base_ids[b], exact


def _searched(space: Space, base: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): each cell's k best for the queries that visit it.

    ``base``: (cell, vec_id, vector); ``queries``: (cell, query_id, vector, bound).
    Big cells are dealt in parts, and so are many queries of a cell.
    """
    sizes = base.groupBy("cell").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    asked = queries.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
    # A row for each cell at most, and there are at most 2 ** DEEPEST.
    grid = F.broadcast(sizes.join(asked, "cell"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one_of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = base.join(grid, "cell").select("cell", one_of("vec_id", "parts").alias("part"), spread("turns").alias("turn"), "vec_id", "vector")
    right = queries.join(grid, "cell").select("cell", spread("parts").alias("part"), one_of("query_id", "turns").alias("turn"), "query_id", "vector", "bound")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"query_id": none, "vec_id": none, "score": pa.array([], pa.float64())})
        ids = right.column("query_id").to_numpy()
        q, found, score = space.search(
            left.column("vec_id").to_numpy(), matrix(left.column("vector"), space.width),
            ids, matrix(right.column("vector"), space.width), right.column("bound").to_numpy(), k,
        )
        return pa.table({"query_id": ids[q], "vec_id": found, "score": score})

    keys = ["cell", "part", "turn"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    projections: int = PROJECTIONS,
    confidence: float = CONFIDENCE,
    seed: int = 42,
) -> DataFrame:
    """query_id, rank, the key and the score of the k rows with the largest inner product.

    Both tables have ``key`` (a long) and ``vector``. A row isn't its own
    neighbour, which goes by the key. Unusable vectors (null, zero, or with
    components that are null or not finite) and null keys take no part. Of query
    rows with the same key, the smallest vector asks; repeated other rows are
    found each for itself. Vectors shorter than the longest are filled with
    zeros. Other columns are left out; an empty table gives an empty result.
    """
    if projections % 2:
        raise ValueError("the number of projections must be even")
    tidy = lambda df: df.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), as_doubles(vector).alias("vector")
    ).where(usable("vector") & F.col("vec_id").isNotNull())
    base, asking = tidy(rows), tidy(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    width, largest, n = base.agg(F.max(F.size("vector")), F.max(F.sqrt(square)), F.count("*")).first()
    longest = asking.agg(F.max(F.size("vector"))).first()[0]
    space = Space(max(width or 1, longest or 1), largest or 1.0, projections, confidence, seed)
    chosen = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    sample = matrix(pa.array([r[0] for r in chosen], pa.list_(pa.float64())), space.width)
    space.tree = Tree(space.points(sample), min(DEEPEST, max(0, math.ceil(math.log2(max(1, n / CELL))))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = space.tree.cell(space.points(matrix(batch.column("vector"), space.width)))
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "vec_id", "vector"])

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = space.tree.cell(space.query_points(matrix(batch.column("vector"), space.width)))
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "query_id", "vector"])

    indexed = stored(base.mapInArrow(place, "cell long, vec_id long, vector array<double>"), "indexed")
    homes = stored(asking.mapInArrow(home, "cell long, query_id long, vector array<double>"), "queries")
    nothing = F.lit(float("-inf"))
    first = stored(_best(_searched(space, indexed, homes.withColumn("bound", nothing), k), k), "first")
    bounds = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    bounded = homes.join(bounds, "query_id", "left").na.fill(float("-inf"), ["bound"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), space.width)
            bound = batch.column("bound").to_numpy()
            away = box_distances(space.query_points(x), space.tree.low, space.tree.high)
            reach = space.distance(bound, np.linalg.norm(x, axis=1)) * space.stop
            visit = (away <= reach[:, None]) | np.isneginf(bound)[:, None]
            visit[np.arange(len(x)), batch.column("cell").to_numpy()] = False
            row, cell = np.nonzero(visit)
            take = pa.array(row)
            columns = [batch.column(c).take(take) for c in ("query_id", "vector", "bound")]
            yield pa.RecordBatch.from_arrays([pa.array(cell), *columns], names=["cell", "query_id", "vector", "bound"])

    visits = bounded.select("cell", "query_id", "vector", "bound").mapInArrow(
        others, "cell long, query_id long, vector array<double>, bound double"
    )
    second = _searched(space, indexed, visits, k)
    return _best(first.select("query_id", "vec_id", "score").unionByName(second), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(key), "score"
    )
