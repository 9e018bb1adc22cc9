"""Gazetteer and point-in-polygon joins, and their counters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.geometry import clip_parts, envelope, rings, shape_area, shape_edges, strictly_inside
from panelwatch.functions.text import place_key
from panelwatch.operators.ordering import MAX_JOIN_SALTS, shuffle_partitions
from panelwatch.settings import DEFAULT_DENSITY_PER_KM2

#: Binary logarithm of the least width of a tile, so that its number stays a whole number.
FINEST = -30


def drop_bad_coordinates(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Null and exactly zero coordinates mean 'unknown'."""
    return points.where((F.col(lon) != 0) & (F.col(lat) != 0))


def geocode(events: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Inner join on the folded place name; a name listed twice yields two rows.

    One municipality may report most events: the join is left to Spark, which broadcasts a small
    gazetteer and otherwise splits the tasks of a hot name at run time (adaptive skew join)
    instead of copying the gazetteer beforehand.
    """
    keyed = events.withColumn("place", place_key(F.col(name)))
    return keyed.join(places, "place")


def geocode_rate(events: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Matched and unmatched events. Events are counted per name before they meet the gazetteer."""
    named = events.groupBy(place_key(F.col(name)).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    known = places.select("place").distinct().withColumn("_hit", F.lit(1))
    row = named.join(known, "place", "left").agg(
        F.sum("n").alias("n_eventos"),
        F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("n"))), F.lit(0)).alias("n_con_coord"),
    )
    return row.select(
        "n_eventos",
        "n_con_coord",
        (F.col("n_eventos") - F.col("n_con_coord")).alias("n_sin_coord"),
        F.try_divide(F.col("n_con_coord").cast("double"), F.col("n_eventos").cast("double")).alias("tasa"),
    )


def bbox_prune(polygons: DataFrame, xmin, xmax, ymin, ymax) -> DataFrame:
    """Polygons whose envelope meets a box (given as columns, e.g. scalar subqueries)."""
    boxed = polygons.select("*", *envelope(F.flatten(rings(polygons))))
    return boxed.where(
        (F.col("xmin") <= xmax)
        & (F.col("xmax") >= xmin)
        & (F.col("ymin") <= ymax)
        & (F.col("ymax") >= ymin)
    )


def clipped(polygons: DataFrame, boundary: list[tuple[float, float]]) -> DataFrame:
    """Polygons (with ``parts``) cut to a convex boundary, with ``area`` above 0."""
    # An explosion of one: what it holds is computed once, not again for the filter.
    cut = F.explode(F.transform(F.array(clip_parts(F.col("parts"), boundary)), lambda p: F.struct(p.alias("parts"), shape_area(p).alias("area"))))
    kept = polygons.withColumn("_cut", cut).where("_cut.area > 0")
    return kept.withColumns({"parts": F.col("_cut.parts"), "area": F.col("_cut.area")}).drop("_cut")


def _leveled(polygons: DataFrame, finest: int) -> DataFrame:
    """unit_id, edges, envelope and level in the quadtree of each polygon that has an extent.

    Polygons of few bytes may be long work, and the tables they are made from lie in few files: they
    are spread over a fixed number of partitions before anything is computed. The envelope is an
    explosion of one, so that filters on it aren't computed before the polygons are spread.
    """
    spread = polygons.select("unit_id", rings(polygons).alias("_rings")).repartition(shuffle_partitions(polygons), "unit_id")
    box = F.explode(F.array(F.struct(*envelope(F.flatten("_rings")))))
    boxed = spread.withColumn("_box", box).select("unit_id", "_box.*", shape_edges(F.col("_rings")).alias("_edges"))
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    level = F.ceil(F.log2(extent)).cast("int")
    level = F.when(F.pow(F.lit(2.0), level) < extent, level + 1).otherwise(level)
    return boxed.where((F.col("xmax") > F.col("xmin")) & (F.col("ymax") > F.col("ymin"))).withColumn(
        "_level", F.greatest(level, F.lit(finest))
    )


def quad_tiles(polygons: DataFrame, finest: int = FINEST) -> DataFrame:
    """unit_id, edges and envelope for each tile that a polygon's envelope touches.

    A polygon is kept at the level of a quadtree whose tiles are just wider than its envelope, so
    that it touches four tiles at most, whatever its size; ``_level`` is the binary logarithm of
    their width. Polygons without extent hold no point and have no tile.
    """
    along = lambda low, high: F.explode(F.sequence(_tile(F.col(low)), _tile(F.col(high))))
    return _leveled(polygons, finest).withColumn("_tx", along("xmin", "xmax")).withColumn("_ty", along("ymin", "ymax"))


def _tile(coordinate: Column) -> Column:
    return F.floor(coordinate / F.pow(F.lit(2.0), F.col("_level")))


def point_in_polygon(
    points: DataFrame,
    polygons: DataFrame,
    tile: float | None = None,
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """Points strictly within polygons; overlaps give several rows, outside points none.

    Holes are outside, parts inside (even-odd rule over all rings), borders outside. Both sides
    meet in tiles of a quadtree: a polygon has four at most (``quad_tiles``), a point one on each
    level that any polygon is on (their number grows with the logarithm of the range of sizes).
    ``tile`` is the least width of a tile. Large polygons and all points may share few tiles, and
    few bytes may be long work: each tile is a square of slices, polygons in its rows and points
    in its columns, so that each pair meets once, in a fixed number of partitions.
    """
    wide = shuffle_partitions(points)
    side = math.ceil(math.sqrt(min(MAX_JOIN_SALTS, wide)))
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    own = lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(side)).cast("int")
    finest = FINEST if tile is None else math.floor(math.log2(tile))
    tiles = quad_tiles(polygons, finest)
    levels = _leveled(polygons, finest).agg(F.collect_set("_level")).scalar()  # one for each size of doubles at most
    placed = (
        points.withColumn("_level", F.explode(levels)).withColumn("_tx", _tile(F.col(lon))).withColumn("_ty", _tile(F.col(lat)))
    )
    on = ["_level", "_tx", "_ty", "_row", "_column"]
    tiles = tiles.withColumn("_row", own("unit_id")).withColumn("_column", every).repartition(wide, *on)
    placed = placed.withColumn("_column", own(lon, lat)).withColumn("_row", every).repartition(wide, *on)
    near = placed.join(tiles, on).where(
        F.col(lon).between(F.col("xmin"), F.col("xmax"))
        & F.col(lat).between(F.col("ymin"), F.col("ymax"))
    )
    inside = near.where(strictly_inside(F.col(lon), F.col(lat), F.col("_edges")))
    return inside.select(*points.columns, "unit_id")


def unit_population(
    units: DataFrame, polygons: DataFrame, places: DataFrame, fallback: bool = True
) -> DataFrame:
    """People per unit: sum over the places inside it.

    Without a census figure the unit gets 120 people per square kilometre, rounded
    half to even; with ``fallback=False`` it gets 0.
    """
    inside = point_in_polygon(places, polygons)
    people = inside.groupBy("unit_id").agg(F.sum("pop").cast("double").alias("_pop"))
    estimate = F.bround(F.col("sub_area") * DEFAULT_DENSITY_PER_KM2) if fallback else F.lit(0.0)
    return units.join(people, "unit_id", "left").select(
        *units.columns, F.coalesce("_pop", estimate).alias("poblacion_estimada")
    )
