"""Points and rings as native expressions. A ring is ``array<struct<x, y>>``, closed.

A shape has either one ``ring``, or ``parts``: an array of polygons, each an array of rings of which
the first is the outline and the others are holes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rings(shapes: DataFrame) -> Column:
    """All rings of a row's shape."""
    return F.flatten("parts") if "parts" in shapes.columns else F.array("ring")


def envelope(ring: Column) -> list[Column]:
    xs, ys = F.transform(ring, lambda c: c["x"]), F.transform(ring, lambda c: c["y"])
    return [
        F.array_min(xs).alias("xmin"),
        F.array_max(xs).alias("xmax"),
        F.array_min(ys).alias("ymin"),
        F.array_max(ys).alias("ymax"),
    ]


def edges(ring: Column) -> Column:
    """Consecutive corner pairs, so that the test below reads each edge as one value."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def strictly_inside(x: Column, y: Column, edge_list: Column) -> Column:
    """Even-odd rule, with points on an edge counted as outside.

    An edge counts when it spans ``y`` half-openly and lies to the right of the
    point; a point with zero cross product within the edge's box is on the border.
    """

    def cross(e):
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def on_edge(e):
        return (
            (cross(e) == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    def crosses(e):
        spans = (e["y1"] > y) != (e["y2"] > y)
        right = x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return spans & right

    odd = F.size(F.filter(edge_list, crosses)) % 2 == 1
    return odd & ~F.exists(edge_list, on_edge)


def shape_edges(all_rings: Column) -> Column:
    """Edges of all rings: by the even-odd rule over all of them, holes are outside and parts inside."""
    return F.flatten(F.transform(all_rings, edges))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring, whichever way it turns; 0 for a null or empty one."""
    double = F.aggregate(
        edges(ring), F.lit(0.0), lambda total, e: total + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )
    return F.when(F.size(ring) > 3, F.abs(double) / 2).otherwise(0.0)


def shape_area(parts: Column) -> Column:
    """Outlines less holes."""
    own = lambda part: F.transform(part, ring_area)
    add = lambda total, a: total + a
    of_part = lambda areas: 2 * F.element_at(areas, 1) - F.aggregate(areas, F.lit(0.0), add)
    return F.aggregate(F.transform(F.transform(parts, own), of_part), F.lit(0.0), add)


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def clip_ring(ring: Column, boundary: list[tuple[float, float]]) -> Column:
    """What of a ring lies within a convex boundary, given by its corners counter-clockwise.

    One half-plane after the other: each edge gives the corners of its part on the inner side.
    A ring that falls apart stays one ring whose pieces are joined along the boundary, which
    leaves its area right; nothing left is an empty ring.
    """
    for (ax, ay), (bx, by) in zip(boundary, [*boundary[1:], boundary[0]]):
        side = lambda x, y: (bx - ax) * (y - F.lit(ay)) - (by - ay) * (x - F.lit(ax))  # noqa: B023, E731

        def kept(e: Column) -> Column:
            s, t = side(e["x1"], e["y1"]), side(e["x2"], e["y2"])  # noqa: B023
            end = F.struct(e["x2"].alias("x"), e["y2"].alias("y"))
            share = F.try_divide(s, s - t)
            cut = F.struct(
                (e["x1"] + (e["x2"] - e["x1"]) * share).alias("x"), (e["y1"] + (e["y2"] - e["y1"]) * share).alias("y")
            )
            inside = F.when(s >= 0, F.array(end)).otherwise(F.array(cut, end))
            outside = F.when(s >= 0, F.array(cut)).otherwise(F.slice(F.array(cut), F.lit(1), F.lit(0)))
            return F.when(t >= 0, inside).otherwise(outside)

        # Each step's ring is computed once, as a lambda's variable.
        opened = _once(ring, lambda r: F.flatten(F.transform(edges(r), kept)))  # noqa: B023
        ring = _once(opened, lambda r: F.concat(r, F.slice(r, F.lit(1), F.lit(1))))
    return ring


def clip_parts(parts: Column, boundary: list[tuple[float, float]]) -> Column:
    return F.transform(parts, lambda part: F.transform(part, lambda ring: clip_ring(ring, boundary)))


class TransverseMercator(NamedTuple):
    """A transverse Mercator grid: degrees of its origin, scale, false origin, ellipsoid."""

    lon0: float
    lat0: float = 0.0
    scale: float = 0.9996
    east: float = 500_000.0
    north: float = 0.0
    axis: float = 6_378_137.0
    flattening: float = 1 / 298.257222101

    def to_degrees(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude of grid coordinates (Krueger's series to the fourth order)."""
        n = self.flattening / (2 - self.flattening)
        radius = self.axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        beta = (
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        )
        delta = (
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
            7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35,
            4279 * n**4 / 630,
        )
        xi = (y - self.north) / (self.scale * radius) + self._meridian(n)
        eta = (x - self.east) / (self.scale * radius)
        xi1, eta1 = xi, eta
        for k, b in enumerate(beta, 1):
            xi1 = xi1 - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
            eta1 = eta1 - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        chi = F.asin(F.sin(xi1) / F.cosh(eta1))
        lat = chi
        for k, d in enumerate(delta, 1):
            lat = lat + d * F.sin(2 * k * chi)
        return self.lon0 + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(lat)

    def _meridian(self, n: float) -> float:
        """Rectified latitude of the origin."""
        phi = math.radians(self.lat0)
        e = math.sqrt(self.flattening * (2 - self.flattening))
        conformal = math.asinh(math.tan(phi)) - e * math.atanh(e * math.sin(phi))
        chi = math.atan(math.sinh(conformal))
        alpha = (
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        )
        return chi + sum(a * math.sin(2 * k * chi) for k, a in enumerate(alpha, 1))


def to_degrees(parts: Column, grid: TransverseMercator) -> Column:
    """Shapes on a grid as shapes in longitude and latitude."""

    def corner(c: Column) -> Column:
        lon, lat = grid.to_degrees(c["x"], c["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, corner)))
