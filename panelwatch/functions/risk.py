"""Risk bands and rounding of probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwatch.functions.rounding import exact_round
from panelwatch.settings import Settings

LEVELS = ("Bajo", "Medio", "Alto")


def band(p: Column, settings: Settings = Settings()) -> Column:
    low, medium, high = LEVELS
    return F.when(p < settings.low_band, low).when(p < settings.high_band, medium).otherwise(high)


def published_probability(p: Column) -> Column:
    """Four decimals, half to even; the band of a published row is taken from this value."""
    return exact_round(p, 4)


def index_band(index: Column) -> Column:
    """Band from the historic index, null where there is none."""
    low, medium, high = LEVELS
    return F.when(index > 1000, high).when(index > 200, medium).when(index.isNotNull(), low)


def size_band(up_area: Column, order: Column) -> Column:
    """Last resort of the map: bands by drainage area and stream order."""
    area, rank = F.coalesce(up_area, F.lit(0.0)), F.coalesce(order, F.lit(0))
    low, medium, _ = LEVELS
    return (
        F.when((area > 8000) | (rank >= 5), medium)
        .when((area > 1000) | (rank >= 3), "Bajo-Medio")
        .otherwise(low)
    )
