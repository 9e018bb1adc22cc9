"""Rounding of the exact binary value, as Python's ``round`` and fixed-point formatting do.

Spark's ``round`` and ``bround`` look at the shortest decimal text instead, where
0.30025 is a tie although the number stored is slightly above it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _split(x: Column, digits: int) -> tuple[Column, Column]:
    """(whole steps of 10**-digits below x, exact distance from the middle of the step).

    x is split into a 24-bit head and the exact rest, so that both products are exact.
    """
    scale = F.lit(float(10**digits))
    head = x.cast("float").cast("double")
    steps = F.floor(x * scale).cast("double")
    return steps, (head * scale - steps - 0.5) + (x - head) * scale


def exact_round(x: Column, digits: int) -> Column:
    """Nearest multiple of 10**-digits, ties to the even one."""
    steps, past = _split(x.cast("double"), digits)
    up = (past > 0) | ((past == 0) & (steps % 2 != 0))
    return F.when(up, steps + 1).otherwise(steps) / F.lit(float(10**digits))


def to_fixed(x: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, ties away from zero."""
    size = F.abs(x.cast("double"))
    steps, past = _split(size, digits)
    n = F.when(past >= 0, steps + 1).otherwise(steps).cast("bigint")
    scale = 10**digits
    text = F.floor(n / scale).cast("string")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((n % scale).cast("string"), digits, "0"))
    return F.when((x < 0) & (n > 0), F.concat(F.lit("-"), text)).otherwise(text)
