"""Welch's test statistic and Student's t distribution as column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedpulse.functions.measures import ratio

NODES = 48
DROP = 45.0  # an integral ends where its integrand has fallen by exp(-45)


def _nodes() -> list[tuple[float, float]]:
    """Gauss-Legendre nodes and weights on [0, 1] under x -> x^2 (3-2x).

    The map crowds the nodes at both ends: at the lower one the integrand may fall
    steeply, at the upper one its derivative is unbounded for 1 < dof < 2.
    """
    x, w = np.polynomial.legendre.leggauss(NODES)
    x, w = (x + 1) / 2, w / 2
    return [(float(a * a * (3 - 2 * a)), float(6 * a * (1 - a) * b)) for a, b in zip(x, w)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it.

    The optimizer replaces column references by their definitions when it moves
    filters; a lambda variable keeps the large expression below from multiplying.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def two_sided_p(t: Column, dof: Column) -> Column:
    """P(|T| >= |t|) for T with ``dof`` >= 1 degrees of freedom, also where it is very small.

    With t = sqrt(dof) * tan(theta) the density is proportional to
    cos(theta)^(dof-1); the tail is divided by the whole half-line, so the
    normalising constant is not needed. Either integral is taken relative to the
    integrand's value at its lower end and reaches to where almost nothing is left of that,
    so that a tail far out is as accurate as a near one.
    """
    # As one SQL literal: building it call by call takes longer than a small test.
    nodes = F.expr(f"array({', '.join(f'struct({x!r}D AS x, {w!r}D AS w)' for x, w in _nodes())})")

    def log_cos(angle: Column) -> Column:
        # Near 0 the logarithm of the cosine itself would lose its digits; at pi/2 it has none.
        sine = F.sin(angle)
        return F.log1p(-F.least(sine * sine, F.lit(1 - 2.0**-53))) / 2

    def area(low: Column, power: Column) -> Column:
        """The integral from ``low``, over the integrand there."""
        fallen = F.cos(low) * F.exp(-F.lit(DROP) / F.greatest(power, F.lit(1e-9)))
        at_low = log_cos(low)

        def sum_to(top: Column) -> Column:
            def add(acc: Column, node: Column) -> Column:
                height = F.exp(power * (log_cos(low + (top - low) * node["x"]) - at_low))
                return acc + node["w"] * height

            return (top - low) * F.aggregate(nodes, F.lit(0.0), add)

        return _let(F.greatest(F.acos(fallen), low), sum_to)

    def tail(s: Column) -> Column:
        # A missing t makes the angle, and so the result, NULL.
        return _let(
            F.atan(s["slope"]),
            lambda theta: F.exp(s["power"] * log_cos(theta))
            * area(theta, s["power"])
            / area(F.lit(0.0), s["power"]),
        )

    def angles(s: Column) -> Column:
        return F.struct(
            (s["t"] / F.sqrt(s["dof"])).alias("slope"), (s["dof"] - 1).alias("power")
        )

    arguments = F.struct(F.abs(t).alias("t"), dof.alias("dof"))
    return _let(arguments, lambda s: _let(angles(s), tail))


def welch(
    n_a: Column, mean_a: Column, var_a: Column, n_b: Column, mean_b: Column, var_b: Column
) -> tuple[Column, Column]:
    """t statistic and Welch-Satterthwaite degrees of freedom; NULL without variance."""
    err_a, err_b = ratio(var_a, n_a), ratio(var_b, n_b)
    t = ratio(mean_a - mean_b, F.sqrt(err_a + err_b))
    dof = ratio(
        (err_a + err_b) * (err_a + err_b),
        ratio(err_a * err_a, n_a - 1) + ratio(err_b * err_b, n_b - 1),
    )
    return t, dof
