"""Tails of distributions as native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; it converges in about the root of the degrees of freedom.
TERMS = 300
#: Beyond so many degrees of freedom a corrected normal tail is exact to 1e-9.
MANY = 20_000
_TINY = 1e-300
#: Stirling's series is used from here on; smaller arguments are moved up by the recurrence.
_SHIFT = 8


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number, to about 1e-13."""
    z = x + _SHIFT
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3.0))) + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0)))
    moved = x
    for k in range(1, _SHIFT):
        moved = moved * (x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(moved)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by forward products."""
    away = lambda v: F.when(F.abs(v) < _TINY, _TINY).otherwise(v)
    row = lambda c, d, h: F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def turn(state: Column, factor: Column) -> Column:
        # Each value is named once by going through a lambda's variable.
        def of(v: Column) -> Column:
            return row(v["c"], 1 / v["d"], state["h"] * v["c"] / v["d"])

        both = F.struct(away(1 + factor / state["c"]).alias("c"), away(1 + factor * state["d"]).alias("d"))
        return F.get(F.transform(F.array(both), of), F.lit(0))

    def step(state: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.get(F.transform(F.array(turn(state, even)), lambda s: turn(s, odd)), F.lit(0))

    first = 1 / away(1 - (a + b) * x / (a + 1))
    start = row(F.lit(1.0), first, first)
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["h"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function for 0 <= x <= 1."""
    inside = (x > 0) & (x < 1)
    v = F.when(inside, x).otherwise(0.5)
    front = F.exp(a * F.log(v) + b * F.log(1 - v) + log_gamma(a + b) - log_gamma(a) - log_gamma(b))
    near = F.when(v < (a + 1) / (a + b + 2), front * _fraction(a, b, v) / a).otherwise(1 - front * _fraction(b, a, 1 - v) / b)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(inside, near)


def normal_two_sided(z: Column) -> Column:
    """2 (1 - Phi(|z|)) by the Abramowitz-Stegun 7.1.26 polynomial for erf."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (
        0.254829592
        + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    return poly * F.exp(-x * x)


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of ``n`` pairs, by Student's t with n - 2 degrees.

    Null for fewer than three pairs; 0 for a perfect correlation.
    """
    nu = n.cast("double") - 2
    rest = 1 - r * r
    exact = incomplete_beta(F.greatest(nu, F.lit(1.0)) / 2, F.lit(0.5), rest)
    t = r * F.sqrt(F.try_divide(nu, rest))
    many = normal_two_sided(t * (1 - 1 / (4 * nu)) / F.sqrt(1 + t * t / (2 * nu)))
    return F.when((nu > 0) & (nu <= MANY), exact).when((nu > 0) & (rest > 0), many).when(nu > 0, 0.0)
