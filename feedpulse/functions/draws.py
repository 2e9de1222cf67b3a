"""Reproducible random draws.

A draw is a hash of its key (seed, user, replicate, ...), so a task that is run
again on another executor gives the same numbers, and no random state has to be
kept or shipped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_key(*parts: Column) -> Column:
    return F.xxhash64(*[part.cast("long") for part in parts])


def uniform(*parts: Column) -> Column:
    """Uniform in [0, 1): the upper 53 bits of the key's hash."""
    return F.shiftrightunsigned(draw_key(*parts), 11).cast("double") * F.lit(2.0**-53)


def poisson_cdf(mean: int) -> list[float]:
    """P(X <= k) for k = 0, 1, ... with X ~ Poisson(mean), up to what 53 bits can tell from 1."""
    cdf, acc = [], 0.0
    for k in range(1_000):
        acc += math.exp(-mean) * mean**k / math.factorial(k)
        cdf.append(acc)
        if k > mean and math.exp(-mean) * mean**k / math.factorial(k) < 2.0**-54:
            break
    return cdf


def poisson(u: Column, mean: int) -> Column:
    """Poisson weight of a uniform draw, by the inverse distribution function."""
    cdf = poisson_cdf(mean)
    weight = F.when(u < cdf[0], F.lit(0))
    for k, bound in enumerate(cdf[1:], start=1):
        weight = weight.when(u < bound, F.lit(k))
    return weight.otherwise(F.lit(len(cdf))).cast("long")


def sample_indices(size: Column, n: int, *key: Column) -> Column:
    """Array of exactly n different indices out of 0..size-1, every subset equally likely.

    Floyd's method: for j from size-n to size-1, an index is drawn from 0..j and
    taken, or j itself if it was taken before. n draws always suffice, whatever the
    size of the group.
    """
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda k: F.struct(
            (size - n + k).alias("j"),
            F.floor(uniform(*key, k) * (size - n + k + 1)).cast("long").alias("drawn"),
        ),
    )
    chosen = F.aggregate(
        steps,
        F.array().cast("array<bigint>"),
        lambda taken, s: F.concat(
            taken, F.array(F.when(F.array_contains(taken, s["drawn"]), s["j"]).otherwise(s["drawn"]))
        ),
    )
    short = F.concat(F.lit(f"sample of {n} asked from a group of "), size.cast("string"))
    return F.when(size < n, F.raise_error(short).cast("array<bigint>")).otherwise(chosen)
