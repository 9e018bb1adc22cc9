"""Small column helpers: sniffing by name, lenient casts, ordered projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_column(df: DataFrame, *fragments: str, required: bool = True) -> str | None:
    """First column whose lower-cased name contains one of the fragments (decided at plan time)."""
    for name in df.columns:
        if any(f in name.lower() for f in fragments):
            return name
    if required:
        raise ValueError(f"no column matching {fragments} among {df.columns}")
    return None


def to_double(c: Column) -> Column:
    """Number or null; NaN becomes null, as Spark would order NaN above every number."""
    value = c.try_cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def to_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def number_or_zero(c: Column) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def ordered_features(df: DataFrame, names: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Keys plus the features in the given order; absent ones become null doubles."""
    present = set(df.columns)
    features = [
        F.col(n).cast("double").alias(n) if n in present else F.lit(None).cast("double").alias(n)
        for n in names
    ]
    return df.select(*keep, *features)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient with 0 for a zero (or null) denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
