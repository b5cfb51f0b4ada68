"""Column expressions on points and rings (FN06, FN08, GEO02, GEO07, GEO08, GEO14).

A ring is ``array<array<double>>`` of (x, y) vertices, a polygon is an array of rings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84 ellipsoid and the authalic cylindrical grid (true scale at 30 degrees).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
WGS84_E = math.sqrt(WGS84_E2)
EQUAL_AREA_LATITUDE = math.radians(30)
EQUAL_AREA_K0 = math.cos(EQUAL_AREA_LATITUDE) / math.sqrt(
    1 - WGS84_E2 * math.sin(EQUAL_AREA_LATITUDE) ** 2
)


def grid_cell(coord: Column, per_degree: int) -> Column:
    """The integer index of a display grid cell; a tenth of a degree is ``per_degree=10``."""
    return F.floor(coord * per_degree)


def cell_index(coord: Column, size: float) -> Column:
    return F.floor(coord / F.lit(float(size)))


def segments(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    count = F.size(ring)
    starts = F.slice(ring, F.lit(1), F.greatest(count - 1, F.lit(0)))
    ends = F.slice(ring, F.lit(2), F.greatest(count - 1, F.lit(0)))
    return F.arrays_zip(starts.alias("a"), ends.alias("b"))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area: counter-clockwise is positive.

    Vertices are taken relative to the first one, which keeps the products small.
    """
    x0, y0 = ring[0][0], ring[0][1]
    return F.aggregate(
        segments(ring),
        F.lit(0.0),
        lambda total, s: total
        + ((s["a"][0] - x0) * (s["b"][1] - y0) - (s["b"][0] - x0) * (s["a"][1] - y0)) / 2,
    )


def ring_moment(ring: Column, axis: int) -> Column:
    """Area-weighted coordinate sum of a ring, relative to its first vertex."""
    x0, y0 = ring[0][0], ring[0][1]
    origin = ring[0][axis]
    return F.aggregate(
        segments(ring),
        F.lit(0.0),
        lambda total, s: total
        + (s["a"][axis] + s["b"][axis] - 2 * origin)
        * ((s["a"][0] - x0) * (s["b"][1] - y0) - (s["b"][0] - x0) * (s["a"][1] - y0))
        / 6,
    )


def ring_is_closed(ring: Column) -> Column:
    return (ring[0][0] == F.element_at(ring, -1)[0]) & (ring[0][1] == F.element_at(ring, -1)[1])


def rings_bound(rings: Column, axis: int, largest: bool) -> Column:
    """Minimum or maximum coordinate over all rings."""
    flat = F.transform(F.flatten(rings), lambda p: p[axis])
    return F.array_max(flat) if largest else F.array_min(flat)


def rings_area(rings: Column) -> Column:
    """Area of a polygon whose shells and holes turn opposite ways, or whose first ring is the shell."""
    signed = F.transform(rings, ring_area)
    return F.aggregate(
        signed,
        F.lit(0.0),
        lambda total, area: total + F.when(area > 0, area).otherwise(area),
        lambda total: F.abs(total),
    )


def centroid(rings: Column) -> tuple[Column, Column]:
    """Area-weighted centroid of oriented rings."""
    area = F.aggregate(F.transform(rings, ring_area), F.lit(0.0), lambda t, a: t + a)

    def coordinate(axis: int) -> Column:
        total = F.aggregate(
            F.transform(
                rings, lambda ring: ring_moment(ring, axis) + ring[0][axis] * ring_area(ring)
            ),
            F.lit(0.0),
            lambda t, m: t + m,
        )
        return F.when(area != 0, total / area)

    return coordinate(0), coordinate(1)


def to_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:4326 degrees to EPSG:3857 metres."""
    return (
        F.radians(x) * WGS84_A,
        F.log(F.tan(F.lit(math.pi / 4) + F.radians(y) / 2)) * WGS84_A,
    )


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres to EPSG:4326 degrees."""
    return (
        F.degrees(x / WGS84_A),
        F.degrees(F.lit(2.0) * F.atan(F.exp(y / WGS84_A)) - math.pi / 2),
    )


def to_equal_area(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:4326 degrees to EPSG:6933 metres: areas in this plane are true areas."""
    s = F.sin(F.radians(y))
    q = (1 - WGS84_E2) * (
        s / (1 - WGS84_E2 * s * s)
        - F.log((1 - WGS84_E * s) / (1 + WGS84_E * s)) / (2 * WGS84_E)
    )
    return F.radians(x) * (WGS84_A * EQUAL_AREA_K0), q * (WGS84_A / (2 * EQUAL_AREA_K0))
