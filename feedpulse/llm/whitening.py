"""Whitening embeddings with eigenvectors refined in mixed precision.

The covariance is added up by Spark in two passes, means first, and is as large as
the vectors' dimension squared, whatever the number of rows. Its eigenvectors are
computed in single precision and corrected by the matrix multiplications of Ogita and
Aishima in extended precision, which about double the correct digits each time. Where
eigenvalues are too close for that to tell their vectors apart, the vectors span the
right space; the covariance within that space is solved as a small problem of its own.

Vectors are read as integers (``64 * c`` and an offset), whose sums are exact, so the
means do not depend on how the rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.sources.scratch import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Larger entries count as this large, so that integers and doubles stay exact.
LARGEST = 1 << 50
LOW = 26
STEPS, ROWS = 12, 64


# Integers


def integers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): rows whose vector is not null and has only finite entries."""
    v = F.col(f"`{vector}`")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    as_integer = lambda c: (
        F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))) + OFFSET
    )
    usable = F.coalesce(v.isNotNull() & F.forall(v, finite), F.lit(False))
    return rows.where(usable).select(F.col(f"`{key}`").alias("key"), F.transform(v, as_integer).alias("x"))


def integer_matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of ``x``; what shorter vectors lack is read as 0."""
    counts = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (counts == width).all():
        return flat.reshape(len(counts), width)
    out = np.full((len(counts), width), OFFSET, dtype=np.int64)
    out[np.arange(width)[None, :] < counts[:, None]] = flat
    return out


# Sums over all rows


def added_up(
    rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double"
) -> np.ndarray:
    """The sum of ``part`` (matrix to matrix) over all batches of ``x``: by task, by row of the matrix, in all.

    Tasks hand on one matrix each. Its rows are added in an order that does not depend on which task ended first.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(integer_matrix(batch.column(0), width))
                total = found if total is None else total + found
        if total is not None:
            task = np.full(len(total), TaskContext.get().partitionId(), dtype=np.int64)
            values = pa.array(list(total), pa.list_(pa.from_numpy_dtype(total.dtype)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(task), values], names=names)

    def together(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        values = np.array(group.column("v").to_pylist())
        return pa.table(
            {"i": group.column("i")[:1], "task": group.column("task")[:1], "v": [values.sum(axis=0).tolist()]},
            schema=group.schema,
        )

    names = ["i", "task", "v"]
    schema = f"i long, task long, v array<{kind}>"
    sums = rows.select("x").mapInArrow(own, schema)
    # First by some tasks each, then all: a group has at most as many rows as there are tasks by ROWS.
    some = sums.withColumn("lot", F.floor(F.col("task") / ROWS)).groupBy("i", "lot").applyInArrow(
        lambda group: together(group.select(names)), schema
    )
    return np.array([r.v for r in some.groupBy("i").applyInArrow(together, schema).orderBy("i").collect()])


def halves(x: np.ndarray) -> np.ndarray:
    """Sums of the upper and of the lower bits by column, and the number of rows: none overflows."""
    low = x & ((1 << LOW) - 1)
    return np.stack([(x >> LOW).sum(axis=0), low.sum(axis=0), np.full(x.shape[1], len(x))])


def moments(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """n and the sums of the integer vectors, exactly."""
    sums = added_up(rows, width, halves, "long")
    if not len(sums):
        return 0, [0] * width
    high, low, n = sums.tolist()
    return n[0], [(h << LOW) + b for h, b in zip(high, low, strict=True)]


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as an integer and a fraction below 1, by column."""
    return np.array([s // n for s in sums], dtype=np.int64), np.array([float(Fraction(s % n, n)) for s in sums])


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Of the integer vectors, centred before they are multiplied, with divisor n."""
    whole, rest = centre(n, sums)

    def part(x: np.ndarray) -> np.ndarray:
        y = (x - whole).astype(np.float64) - rest
        return y.T @ y

    found = added_up(rows, len(sums), part) / n
    return (found + found.T) / 2


# Eigenvectors


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of falling values, two at least, of which each is within ``width`` of the next."""
    breaks = np.flatnonzero(values[:-1] - values[1:] > width) + 1
    return [c for c in np.split(np.arange(len(values)), breaks) if len(c) > 1]


def eigen(a: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and the unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Starts in single precision; multiplications are in extended precision where the
    machine has it. Vectors of equal eigenvalues are some basis of their space.
    """
    a = np.asarray(a, dtype=np.longdouble)
    scale = np.abs(a).max()
    if not scale > 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    tiny = np.finfo(np.float64).eps / 8
    for _ in range(steps):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = float(np.abs(r).sum(axis=0).max() + np.abs(off).sum(axis=0).max())
        # Below this distance, the correction cannot tell two vectors apart.
        close = 2 * float(np.linalg.norm(off.astype(float), 2) + np.linalg.norm(r.astype(float), 2))
        apart = values[None, :] - values[:, None]
        clear = np.abs(apart) > close
        x = x + x @ np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        groups = clusters(values, close)
        for c in groups:
            y = x[:, c]
            middle = values[c].mean()
            inner = y.T @ (a @ y) - middle * (y.T @ y)
            inner = (inner + inner.T) / 2
            size = np.abs(inner).max()
            if size > 0:  # scaled up, so that the small problem has all digits
                x[:, c] = y @ np.linalg.eigh((inner / size).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
        if error < tiny * len(a):
            break
    x = x + x @ ((one - x.T @ x) / 2)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


# Whitening


def squared(n: int, sums: np.ndarray, x: np.ndarray, safe: bool) -> list[int | None]:
    """The sum of (n * x - S)^2 of each row; null where it exceeds a long."""
    if safe:
        y = n * x - sums.astype(np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - sums
    return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def whitened(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error for every row with a usable vector.

    An entry c counts as the integer x = floor(64 * c) + 1,000,000 (beyond +-2^50 / 64 as
    that; what a vector is shorter than the longest as 0). Different x vectors
    are the fit list: n, the sums S and every covariance are over it. ``component`` goes from 1
    by falling eigenvalue. ``deviation`` is null beyond a long. A component without variance,
    as of a single vector or beyond the fit list's rank, has null ``whitened``, and ``identity_error`` is over
    the others; ``explained`` is null if nothing varies. Rows with null vectors or entries that
    are null or not finite are left out, repeated rows and null keys are not; other
    columns are not looked at. The driver holds the square of the vectors' length.
    """
    spark = rows.sparkSession
    name = f"`{key}`"
    kind = rows.schema[key].dataType.simpleString()
    out = (
        f"{name} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    usable = stored(integers(rows, key, vector), "integers")
    width = usable.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return spark.createDataFrame([], out)
    # Shorter vectors are filled up, so that equal ones are one.
    filled = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x")))
    fit = stored(usable.select(filled.alias("x")).distinct(), "fit")
    n, sums = moments(fit, width)
    spread_of_x = covariance(fit, n, sums)
    trace = float(np.trace(spread_of_x))
    values, vectors = eigen(spread_of_x)
    values, vectors = values[:components], vectors[:, :components]
    varies = values > trace * width * np.finfo(np.float64).eps * 4
    whole, rest = centre(n, sums)
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1)), 0.0)
    projection = vectors * scale

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - whole).astype(np.float64) - rest) @ projection

    mean = added_up(fit, width, lambda x: project(x).sum(axis=0)[None, :])[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        y = project(x) - mean
        return y.T @ y

    off = added_up(fit, width, spread) / n - np.eye(len(values))
    error = float(np.abs(off[np.ix_(varies, varies)]).max()) if varies.any() else None
    explained = (values / trace).tolist() if trace > 0 else [None] * len(values)
    exact_sums, numbers = np.array(sums, dtype=object), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integer_matrix(batch.column(1), width)
            if not len(x):
                continue
            largest = int(np.abs(x - whole).max()) + 1
            safe = (n * largest) ** 2 * width < 1 << 62 and n * (int(np.abs(x).max()) + 1) < 1 << 62
            deviation = squared(n, exact_sums, x, safe)
            white = project(x)
            white_array = pa.array(white.ravel(), mask=np.tile(~varies, len(x)))
            at = pa.array(np.repeat(np.arange(len(x)), numbers))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, numbers + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), n)),
                    pa.array(deviation, pa.int64()).take(at),
                    white_array,
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * len(at), pa.float64()),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable.mapInArrow(run, out)

