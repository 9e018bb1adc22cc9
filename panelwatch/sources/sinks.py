"""Stored panel, exports, weekly documents and the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.calendar import week_label
from panelwatch.functions.risk import LEVELS, band, published_probability
from panelwatch.functions.rounding import exact_round
from panelwatch.operators.panel import panel_years

#: Writers for the units of one week.
WEEK_WRITERS = 16


def write_panel(cells: DataFrame, path: str) -> None:
    """Parquet by year of the week, so that a span of years or one week reads few files.

    Rows are spread by week and by a hash of the unit, so that neither a year nor a week
    is one task.
    """
    labelled = panel_years(cells).withColumn("anio_semana", week_label(F.col("week_start")))
    (
        labelled.repartition("year", "week_start", F.pmod(F.xxhash64("unit_id"), F.lit(WEEK_WRITERS)))
        .sortWithinPartitions("week_start", "unit_id")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def predictions(scored: DataFrame, stamp: Column) -> DataFrame:
    """Published rows: probability to four decimals, and the band of that value."""
    p = published_probability(F.col("p"))
    return scored.select(
        "week_start",
        "unit_id",
        p.alias("probabilidad_deslizamiento"),
        band(p).alias("nivel_riesgo"),
        stamp.alias("timestamp"),
    )


def band_counts(published: DataFrame, keys: Sequence[str] = ("week_start",)) -> DataFrame:
    return published.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cuencas"),
        *[
            F.count_if(F.col("nivel_riesgo") == level).alias(level.lower())
            for level in reversed(LEVELS)
        ],
    )


def week_documents(published: DataFrame, features: Sequence[str]) -> DataFrame:
    """week_start, unit_id, documento: JSON lines that make up the document of each week.

    One line for each unit, and one with the counts per band of the whole week, whose
    ``unit_id`` is null: the same form for any number of units, and no list that grows.
    High-risk units are marked in their own lines.
    """
    semana = week_label(F.col("week_start")).alias("semana")
    result = F.struct(
        semana,
        F.col("unit_id").alias("hybas_id"),
        "probabilidad_deslizamiento",
        "nivel_riesgo",
        (F.col("nivel_riesgo") == LEVELS[2]).alias("alto_riesgo"),
        "timestamp",
    )
    units = published.select("week_start", "unit_id", F.to_json(result).alias("documento"))
    stamps = published.groupBy("week_start").agg(F.max("timestamp").alias("generado_utc"))
    summary = F.struct(
        semana,
        "n_cuencas",
        F.struct("alto", "medio", "bajo").alias("resumen"),
        "generado_utc",
        F.array(*[F.lit(f) for f in features]).alias("features_usadas"),
    )
    weeks = band_counts(published).join(stamps, "week_start")
    no_unit = F.lit(None).cast(published.schema["unit_id"].dataType).alias("unit_id")
    return units.unionByName(weeks.select("week_start", no_unit, F.to_json(summary).alias("documento")))


def write_documents(documents: DataFrame, path: str) -> None:
    """One folder per week, one line per unit and one for the week."""
    lines = documents.select("week_start", "documento")
    lines.write.mode("overwrite").partitionBy("week_start").text(path)


def geojson_features(polygons: DataFrame, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON feature per row; rings are lon/lat and already closed.

    A ``ring`` is a Polygon, ``parts`` (with their holes) a MultiPolygon.
    """
    ring = lambda r: F.transform(r, lambda c: F.array(c["x"], c["y"]))
    if "parts" in polygons.columns:
        kind, coordinates = "MultiPolygon", F.transform("parts", lambda part: F.transform(part, ring))
    else:
        kind, coordinates = "Polygon", F.array(ring("ring"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )
    return polygons.select("unit_id", F.to_json(feature).alias("feature"))


def log_entries(served: DataFrame, features: str = "features", row_id: str = "hybas_id") -> DataFrame:
    """Log records: six decimals, features without nulls and without the id."""
    kept = F.map_filter(features, lambda k, v: v.isNotNull() & (k != row_id))
    return served.withColumn("probabilidad", exact_round(F.col("p"), 6)).select(
        *[c for c in ("event_id",) if c in served.columns],
        F.col("ts").alias("timestamp"),
        row_id,
        "probabilidad",
        band(F.col("p")).alias("nivel_riesgo"),
        kept.alias(features),
    )


def append_log(entries: DataFrame, path: str) -> None:
    """Append-only JSON lines."""
    entries.write.mode("append").json(path)
