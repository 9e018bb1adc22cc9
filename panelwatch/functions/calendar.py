"""Monday-to-Sunday weeks, their labels, and cyclic seasonality."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def week_end(week: Column) -> Column:
    return F.date_add(week, 6)


def week_label(week: Column) -> Column:
    """Printed form of a week, ``2021-01-04/2021-01-10``."""
    return F.concat_ws(
        "/", F.date_format(week, "yyyy-MM-dd"), F.date_format(week_end(week), "yyyy-MM-dd")
    )


def parse_week(label: Column) -> Column:
    """Week of a label ``a/b`` or of a single day ``a``; unreadable text gives null."""
    first = F.trim(F.split_part(label, F.lit("/"), F.lit(1)))
    return week_start(F.try_to_timestamp(first, F.lit("yyyy-MM-dd")))


def week_year(week: Column, anchor: str = "start") -> Column:
    """Calendar year of a week, read at its Monday (``start``) or its Sunday (``end``)."""
    if anchor not in ("start", "end"):
        raise ValueError("anchor must be 'start' or 'end'")
    return F.year(week if anchor == "start" else week_end(week))


def iso_year(day: Column) -> Column:
    return F.year(F.date_add(week_start(day), 3))


def iso_label(day: Column) -> Column:
    """ISO label such as ``2020-W53``."""
    return F.format_string("%d-W%02d", iso_year(day), F.weekofyear(day))


def cyclic(position: Column, period: int, prefix: str) -> list[Column]:
    angle = F.lit(2 * math.pi) * position / F.lit(period)
    return [F.sin(angle).alias(f"{prefix}_sin"), F.cos(angle).alias(f"{prefix}_cos")]


def seasonality(day_for_week: Column, day_for_month: Column) -> list[Column]:
    """Week-of-year and month encodings; the two may be read at different days of the week."""
    return cyclic(F.weekofyear(day_for_week), 52, "semana") + cyclic(
        F.month(day_for_month), 12, "mes"
    )


def client_seasonality(day: Column) -> list[Column]:
    """Variant of the form client: week = ceil(day of year / 7), six decimals."""
    week = F.ceil(F.dayofyear(day) / 7)
    pairs = zip(
        cyclic(week, 52, "semana") + cyclic(F.month(day), 12, "mes"),
        ("semana_sin", "semana_cos", "mes_sin", "mes_cos"),
    )
    return [F.round(c, 6).alias(name) for c, name in pairs]
