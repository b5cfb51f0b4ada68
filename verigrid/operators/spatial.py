"""Polygons on Spark: parse, assess, point in polygon, overlay areas (GEO01-GEO16, JOIN09, JOIN10).

A polygon is an array of rings; shells turn counter-clockwise and holes clockwise
after ``parse_polygons``. Large polygons never travel as a whole: ``cut`` turns rings
into edges and spreads the edges over grid cells, so every later step works on the
few edges of one cell. The cell size is a tuning knob and never changes a result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.functions.geometry import from_mercator, ring_area, ring_is_closed, rings_bound, segments
from verigrid.functions.text import unquote_numbers
from verigrid.operators.scale import lookup, with_context
from verigrid.sinks.stage import materialize

RING = "array<array<double>>"
POLYGON = f"array<{RING}>"
MULTI = f"array<{POLYGON}>"
SALTS = 32
HOT_CELLS = 256
#: Polygons that travel in one row with their common shape; a tuning knob.
MEMBERS = 4096


# --- parsing and status -------------------------------------------------------

def _complete(rings: Column) -> Column:
    """Every vertex has two numbers; a partly parsed array is no geometry."""
    return F.forall(
        rings, lambda ring: F.forall(ring, lambda p: (F.size(p) >= 2) & p[0].isNotNull() & p[1].isNotNull())
    )


def orient(ring: Column, counter_clockwise: bool) -> Column:
    area = ring_area(ring)
    turned = (area >= 0) if counter_clockwise else (area <= 0)
    return F.when(turned, ring).otherwise(F.reverse(ring))


def _shell_first(rings: Column) -> Column:
    """GeoJSON order: the first ring is the shell, the others are holes."""
    return F.transform(
        rings, lambda ring, i: F.when(i == 0, orient(ring, True)).otherwise(orient(ring, False))
    )


def esri_rings(rings: Column) -> Column:
    """Esri rings turn the other way: clockwise is a shell, counter-clockwise a hole."""
    return F.transform(rings, F.reverse)


# The codes under which Esri names the spherical Mercator plane in metres.
MERCATOR_CODES = ("102100", "102113", "3857", "900913")


def degrees_of(rings: Column, metres: Column) -> Column:
    """Rings in degrees; those in Mercator metres are turned back."""
    turned = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(*from_mercator(p[0], p[1]))))
    return F.when(metres, turned).otherwise(rings)


def ring_roles(rings: Column) -> tuple[Column, Column]:
    """Number of shells and holes of oriented rings, by the sign of their area."""
    areas = F.transform(rings, lambda ring: ring_area(ring))
    return F.size(F.filter(areas, lambda a: a > 0)), F.size(F.filter(areas, lambda a: a < 0))


def parse_polygons(df: DataFrame, json: str) -> DataFrame:
    """Add rings, geometry_parse_method and geometry_status.

    GeoJSON as published comes first, then GeoJSON with quoted numbers, then Esri rings. GeoJSON is
    in degrees by its standard; Esri rings whose spatial reference is the Mercator plane come back
    in degrees too.
    """
    text = F.when(F.trim(json) != "", F.trim(json))
    staged = df.withColumn("__text", text).withColumn("__plain", unquote_numbers(F.col("__text")))

    def geojson(column: str) -> Column:
        kind = F.get_json_object(column, "$.type")
        coordinates = F.get_json_object(column, "$.coordinates")
        single = F.from_json(coordinates, POLYGON)
        several = F.from_json(coordinates, MULTI)
        return F.when(
            (kind == "Polygon") & single.isNotNull() & _complete(single), _shell_first(single)
        ).when(
            (kind == "MultiPolygon") & several.isNotNull() & F.forall(several, _complete),
            F.flatten(F.transform(several, _shell_first)),
        )

    esri = F.from_json(F.get_json_object("__plain", "$.rings"), POLYGON)
    wkid = F.coalesce(F.get_json_object("__plain", "$.spatialReference.latestWkid"), F.get_json_object("__plain", "$.spatialReference.wkid"))
    metres = F.coalesce(wkid.isin(*MERCATOR_CODES), F.lit(False))
    staged = staged.withColumns(
        {
            "__kind": F.get_json_object("__text", "$.type"),
            "__published": geojson("__text"),
            "__normalised": geojson("__plain"),
            "__esri": F.when(esri.isNotNull() & _complete(esri), esri_rings(degrees_of(esri, metres))),
        }
    )
    rings = F.coalesce("__published", "__normalised", "__esri")
    other_type = F.col("__kind").isNotNull() & ~F.col("__kind").isin("Polygon", "MultiPolygon")
    return staged.withColumn("rings", rings).withColumns(
        {
            "geometry_parse_method": F.when(F.col("__text").isNull(), "NOT_PARSED")
            .when(F.col("__published").isNotNull(), "GEOJSON_AS_PUBLISHED")
            .when(F.col("__normalised").isNotNull(), "GEOJSON_QUOTED_NUMBERS_NORMALIZED")
            .when(F.col("__esri").isNotNull(), "ESRI_JSON_CONVERTED")
            .otherwise("PARSE_FAILED"),
            "geometry_status": F.when(F.col("__text").isNull(), "BLANK_GEOMETRY")
            .when(other_type, "UNSUPPORTED_GEOMETRY_TYPE")
            .when(F.col("rings").isNull(), "UNPARSEABLE_GEOMETRY")
            .when((F.size("rings") == 0) | F.exists("rings", lambda r: F.size(r) == 0), "EMPTY_GEOMETRY")
            .when(~F.forall("rings", lambda r: (F.size(r) >= 4) & ring_is_closed(r)), "INVALID_GEOMETRY")
            .when(F.exists("rings", lambda r: ring_area(r) == 0), "INVALID_GEOMETRY")
            .otherwise("USABLE_GEOMETRY"),
        }
    ).drop("__text", "__plain", "__kind", "__published", "__normalised", "__esri")


def bounding_box(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Envelope columns of the rings."""
    return df.withColumns(
        {
            "xmin": rings_bound(F.col(rings), 0, False), "xmax": rings_bound(F.col(rings), 0, True),
            "ymin": rings_bound(F.col(rings), 1, False), "ymax": rings_bound(F.col(rings), 1, True),
        }
    )


def degree_screen() -> Column:
    """Whether an envelope can be longitude and latitude in degrees."""
    inside = (
        (F.col("xmin") >= -180) & (F.col("xmax") <= 180) & (F.col("ymin") >= -90) & (F.col("ymax") <= 90)
    )
    return F.when(F.col("xmin").isNull(), "NO_ENVELOPE").when(inside, "DEGREES").otherwise("NOT_DEGREES")


# --- edges and cells ------------------------------------------------------------

def edges(polygons: DataFrame, keys: Sequence[str], transform=None) -> DataFrame:
    """One row per edge with x1 <= x2; ``w`` is +1 when the edge ran to the right.

    ``transform`` maps (x, y) to projected coordinates, once per vertex pair; it must be
    separable and keep the order of y. ``top`` is the polygon's largest y.
    """
    ring = polygons.select(
        *keys, rings_bound(F.col("rings"), 1, True).alias("top"), F.explode("rings").alias("ring")
    )
    pairs = ring.select(*keys, "top", F.explode(segments(F.col("ring"))).alias("s")).select(
        *keys, "top",
        F.col("s.a")[0].alias("ax"), F.col("s.a")[1].alias("ay"),
        F.col("s.b")[0].alias("bx"), F.col("s.b")[1].alias("by"),
    )
    if transform is not None:
        ax, ay = transform(F.col("ax"), F.col("ay"))
        bx, by = transform(F.col("bx"), F.col("by"))
        _, top = transform(F.lit(0.0), F.col("top"))
        pairs = pairs.select(
            *keys, top.alias("top"), ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by")
        )
    right = F.col("ax") <= F.col("bx")
    pick = lambda a, b: F.when(right, F.col(a)).otherwise(F.col(b))
    return pairs.select(
        *keys, "top",
        pick("ax", "bx").alias("x1"), pick("ay", "by").alias("y1"),
        pick("bx", "ax").alias("x2"), pick("by", "ay").alias("y2"),
        F.when(F.col("ax") < F.col("bx"), 1).when(F.col("ax") > F.col("bx"), -1).otherwise(0).alias("w"),
    )


def shape_mark(rings: Column) -> Column:
    """A 256-bit hash of the vertices; a double's text is exact, so equal marks mean equal shapes."""
    return F.sha2(rings.cast("string"), 256)


def merged_lines(edge_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same winding with each stretch of a line once per owner.

    An edge becomes a step at either end of its stretch of its line; steps at one place are
    added up, and between what is left the running sum of the line is the new direction.
    Repeated edges become one, opposite ones vanish, and neighbours that share a border lose
    it. Upright edges turn nothing and go; only areas may be taken from the result.
    """
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    lined = edge_rows.filter((F.col("w") != 0) & (F.col("x1") < F.col("x2"))).withColumn("m", slope)
    lined = lined.withColumn("c", F.col("y1") - F.col("m") * F.col("x1"))
    ends = F.array(
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), F.col("w").cast("bigint").alias("s")),
        F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"), (-F.col("w")).cast("bigint").alias("s")),
    )
    steps = (
        lined.select(*keys, "m", "c", "top", F.inline(ends)).groupBy(*keys, "m", "c", "x")
        .agg(F.sum("s").alias("s"), F.min("y").alias("y"), F.max("top").alias("top"))
        .filter("s <> 0")
    )
    along = W.partitionBy(*keys, "m", "c").orderBy("x")
    swept = steps.withColumns(
        {
            "turns": F.sum("s").over(along.rowsBetween(W.unboundedPreceding, 0)),
            "x2": F.lead("x").over(along), "y2": F.lead("y").over(along),
        }
    )
    return swept.filter("turns <> 0 AND x2 IS NOT NULL").select(
        *keys, "top", F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2", F.col("turns").cast("int").alias("w")
    )


def cell_of(x: Column, step: Column) -> Column:
    """The cell whose borders, as they are computed elsewhere, hold x.

    A division can round across a border that is no binary fraction; comparing with the borders
    themselves puts such a value back.
    """
    cell = F.floor(x / step)
    return F.when(x < cell * step, cell - 1).when(x >= (cell + 1) * step, cell + 1).otherwise(cell)


def cut(edge_rows: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Spread edges over square cells (ix, iy).

    A cell gets the edges that touch it, and, for every polygon, winding steps: what lies
    wholly below the cell only matters by its direction, so an edge below becomes +w where
    it begins and -w where it ends. Steps of neighbouring edges cancel at the vertex they
    share, so a chain leaves its two ends however many vertices it has. What is left at one x
    is carried upwards, row of cells by row of cells, until later steps cancel it. A step
    row holds from ``xa`` to the right side of its strip (``xb``); the polygon covers a point
    when the steps up to it and the edges below it do not cancel out. For edges, ``xa`` to
    ``xb`` is the part inside the strip.
    """
    step = F.lit(float(size))
    strips = edge_rows.withColumn(
        "ix", F.explode(F.sequence(cell_of(F.col("x1"), step), cell_of(F.col("x2"), step)))
    ).withColumns(
        {
            "xa": F.greatest(F.col("x1"), F.col("ix") * step),
            "xb": F.least(F.col("x2"), (F.col("ix") + 1) * step),
        }
    )
    slope = F.when(F.col("x2") > F.col("x1"), (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    at = lambda x: F.when(F.col(x) == F.col("x1"), F.col("y1")).when(
        F.col(x) == F.col("x2"), F.col("y2")
    ).otherwise(F.col("y1") + (F.col(x) - F.col("x1")) * slope)
    vertical = F.col("x1") == F.col("x2")
    ya = F.when(vertical, F.col("y1")).otherwise(at("xa"))
    yb = F.when(vertical, F.col("y2")).otherwise(at("xb"))
    spans = strips.withColumns({"lo": F.least(ya, yb), "hi": F.greatest(ya, yb)})
    # a margin far below any coordinate precision keeps rounding from hiding an edge
    margin = F.lit(1e-9) * (F.abs("hi") + 1)
    first = F.floor((F.col("lo") - margin) / step)
    last_own = F.floor((F.col("hi") + margin) / step)
    last = F.floor((F.col("top") + F.lit(1e-9) * (F.abs("top") + 1)) / step)
    own = spans.withColumn("iy", F.explode(F.sequence(first, last_own))).select(
        *keys, "ix", "iy", "x1", "y1", "x2", "y2", "xa", "xb", "w", F.lit(False).alias("is_below")
    )
    right = (F.col("ix") + 1) * step
    ends = F.array(
        F.struct(F.col("xa").alias("x"), F.col("w").cast("bigint").alias("s")),
        F.struct(F.col("xb").alias("x"), (-F.col("w")).cast("bigint").alias("s")),
    )
    steps = (
        spans.filter((F.col("w") != 0) & (F.col("xa") < F.col("xb")) & (last_own < last))
        .select(*keys, "ix", (last_own + 1).alias("iy"), last.alias("last"), F.inline(ends))
        .filter(F.col("x") < right)
        .groupBy(*keys, "ix", "x", "iy")
        .agg(F.sum("s").alias("s"), F.max("last").alias("last"))
        .filter("s <> 0")
    )
    # at most one row per row of cells
    upwards = W.partitionBy(*keys, "ix", "x").orderBy("iy")
    above = (
        steps.withColumns(
            {
                "w": F.sum("s").over(upwards.rowsBetween(W.unboundedPreceding, 0)),
                "until": F.coalesce(F.lead("iy").over(upwards) - 1, F.col("last")),
            }
        )
        .filter("w <> 0 AND iy <= until")
        .withColumn("iy", F.explode(F.sequence("iy", "until")))
        .withColumns({"xa": F.col("x"), "xb": right, "w": F.col("w").cast("int")})
    )
    none = F.lit(None).cast("double")
    above = above.select(
        *keys, "ix", "iy", *[none.alias(c) for c in ("x1", "y1", "x2", "y2")], "xa", "xb", "w",
        F.lit(True).alias("is_below"),
    )
    return own.unionByName(above)


def busy_tasks(spark: SparkSession) -> int:
    """Tasks for steps in which few bytes stand for much work: they follow the cores, not the bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def cell_join(points: DataFrame, pieces: DataFrame, point_id: str) -> DataFrame:
    """Equi join of points and polygon pieces on the cell, with hot cells salted.

    A cell is hot when it holds more than a 1/256 share of the points, so at most 256
    cells are hot and their list may be broadcast. Their points are spread over salts
    and only their pieces are repeated.
    """
    per_cell = points.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n"))
    total = per_cell.agg(F.sum("n").alias("total"))
    hot = (
        per_cell.transform(with_context, total)
        .filter(F.col("n") * HOT_CELLS > F.col("total"))
        .select("ix", "iy", F.lit(True).alias("hot"))
    )
    spread = points.join(F.broadcast(hot), ["ix", "iy"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64(point_id), F.lit(SALTS))).otherwise(F.lit(0))
    )
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = pieces.join(F.broadcast(hot), ["ix", "iy"], "left").withColumn("salt", F.explode(salts))
    tasks = busy_tasks(points.sparkSession)
    dealt = [df.drop("hot").repartition(tasks, "ix", "iy", "salt") for df in (spread, repeated)]
    return dealt[0].join(unsent(dealt[1]), ["ix", "iy", "salt"])


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that never goes through the driver.

    Rows of a written stage repeat most of their values, so a few MB of files can be millions of rows;
    by the size of the files Spark would broadcast them.
    """
    return df.hint("merge")


def equal_shapes(polygons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of every polygon with ``shape``, the least keys among polygons of the same rings, and their number ``n``.

    Rows that share their keys are one polygon, as for the edges. Only marks of the rings travel.
    """
    marks = polygons.select(*keys, shape_mark(F.col("rings")).alias("mark")).groupBy(*keys).agg(
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("mark"))), 256).alias("mark")
    )
    per_mark = marks.groupBy("mark").agg(F.min(F.struct(*keys)).alias("shape"), F.count(F.lit(1)).alias("n"))
    return materialize(lookup(marks, unsent(per_mark), ["mark"], "inner").drop("mark"), "shapes")


PART = ("x1", "y1", "x2", "y2", "xa", "xb", "w", "is_below")


def point_tests(part) -> tuple[Column, Column]:
    """Whether a part of a polygon, given as ``part(name)``, lies below the point (px, py), and whether it holds it."""
    px, py = F.col("px"), F.col("py")
    x1, y1, x2, y2 = (part(name) for name in ("x1", "y1", "x2", "y2"))
    side = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    in_strip = (part("xa") <= px) & (px < part("xb"))
    below = in_strip & (part("is_below") | F.coalesce(side > 0, F.lit(False)))
    on_edge = F.coalesce(
        px.between(x1, x2) & py.between(F.least(y1, y2), F.greatest(y1, y2)) & (side == 0), F.lit(False)
    )
    return below, on_edge


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, point_id: str, polygon_keys: Sequence[str], size: float,
    most_parts: int = 256, count_by: Sequence[str] | None = None,
) -> DataFrame:
    """Pairs (point, polygon) where the polygon covers the point; the boundary counts as inside.

    ``points`` has x and y. Per pair the directions of the edges below the point are
    summed; an odd sum is inside. A point on an edge is inside by an exact test.

    With ``count_by``, some of the polygon keys, the rows are point, these keys and ``polygons``, the
    number of covering polygons; the numbers of equal rows add up. No pair is made then, so the work
    follows points and what differs in a cell, not the number of polygons over a point.

    Polygons of equal rings are cut and tested once. A point meets all parts of a shape in its cell in
    one row, so a pair is settled where it is joined and is not shuffled. Only the pairs of a shape
    with more than ``most_parts`` parts in a cell, and of ids that several points share, are summed
    up part by part.
    """
    step = F.lit(float(size))
    placed = points.select(
        point_id, F.col("x").alias("px"), F.col("y").alias("py"),
        cell_of(F.col("x"), step).alias("ix"), cell_of(F.col("y"), step).alias("iy"),
    )
    times = placed.groupBy(point_id).agg(F.count(F.lit(1)).alias("times"))
    placed = materialize(lookup(placed, unsent(times), [point_id], "inner"), "points")
    single, repeated = (placed.filter(c).drop("times") for c in ("times = 1", "times > 1"))
    shapes = equal_shapes(polygons, polygon_keys)
    first = shapes.filter(F.struct(*polygon_keys).eqNullSafe(F.col("shape"))).select(*polygon_keys)
    rows = materialize(lookup(edges(polygons, polygon_keys), unsent(first), polygon_keys, "left_semi"), "edges")
    cell = [*polygon_keys, "ix", "iy"]
    pieces = materialize(cut(rows, polygon_keys, size), "cut")
    parts = pieces.groupBy(*cell).agg(F.count(F.lit(1)).alias("parts"))
    pieces = materialize(lookup(pieces, unsent(parts), cell, "inner"), "pieces")
    few, many = (pieces.filter(c).drop("parts") for c in (F.col("parts") <= most_parts, F.col("parts") > most_parts))
    # left and right of all parts, and below all where no winding comes from lower cells, nothing is covered
    lowest = F.when(~F.col("is_below"), F.least("y1", "y2")).otherwise(F.lit(float("-inf")))
    bounds = {"left": F.min("xa"), "right": F.max("xb"), "low": F.min(lowest)}
    gathered = few.groupBy(*cell).agg(
        F.sort_array(F.collect_list(F.struct(*PART))).alias("parts"), *[bound.alias(name) for name, bound in bounds.items()]
    )
    if count_by is None:
        chunk = F.pmod(F.xxhash64(*polygon_keys), F.ceil(F.col("n") / MEMBERS))
        members = shapes.groupBy("shape", chunk.alias("chunk")).agg(F.collect_list(F.struct(*polygon_keys)).alias("members"))
        named = members.select("shape.*", "members")
        gathered = lookup(gathered, unsent(named), polygon_keys, "inner")
        told = lambda df: df.select(point_id, F.inline("members"))
    else:
        of_class = shapes.groupBy("shape", F.struct(*count_by).alias("class")).agg(F.count(F.lit(1)).alias("polygons"))
        named = of_class.select("shape.*", "class", "polygons")
        # what looks the same inside a cell is tested once, above all what covers the whole cell
        gathered = lookup(gathered, unsent(named), polygon_keys, "inner").groupBy("ix", "iy", "parts", "class").agg(
            F.sum("polygons").alias("polygons"), *[F.first(name).alias(name) for name in bounds]
        )
        told = lambda df: df.select(point_id, "class.*", "polygons")
    turns = F.aggregate(
        "parts", F.lit(0).cast("bigint"),
        lambda total, p: total + F.when(point_tests(lambda name: p[name])[0], p["w"]).otherwise(0),
    )
    touch = F.exists("parts", lambda p: point_tests(lambda name: p[name])[1])
    only_step = (F.size("parts") == 1) & F.col("parts")[0]["is_below"]
    covered = F.when(only_step, (F.col("px") < F.col("right")) & (F.col("parts")[0]["w"] % 2 != 0)).otherwise(
        (turns % 2 != 0) | touch
    )
    near = F.col("px").between(F.col("left"), F.col("right")) & (F.col("py") >= F.col("low"))
    settled = told(cell_join(single, gathered, point_id).filter(near).filter(covered))
    loose = cell_join(single, many, point_id).unionByName(cell_join(repeated, pieces.drop("parts"), point_id))
    below, on_edge = point_tests(F.col)
    pairs = loose.filter(below | on_edge).groupBy(point_id, *polygon_keys).agg(
        F.sum(F.when(below, F.col("w")).otherwise(0)).alias("turns"), F.bool_or(on_edge).alias("touch")
    )
    summed = pairs.filter((F.col("turns") % 2 != 0) | F.col("touch"))
    return settled.unionByName(told(lookup(summed, unsent(named), polygon_keys, "inner")))


# --- overlay areas ---------------------------------------------------------------

AREA_SCHEMA = "grp string, level string, polygon string, kind string, area double, low_turn int, high_turn int"


def sweep_cell(x1, y1, x2, y2, w, owner, left, right, bottom, top):
    """Slabs of one cell: yields (width, gaps, turns) with one column of turns per owner.

    Slabs end at every edge end, at every crossing of two edges and where an edge meets
    the cell's lower or upper side; inside a slab the order of the edges is fixed, so gap
    times width is an exact area.
    """
    dx, dy = x2 - x1, y2 - y1
    cuts = [np.array([left, right]), x1, x2]
    with np.errstate(divide="ignore", invalid="ignore"):
        for level in (bottom, top):
            hit = x1 + (level - y1) * dx / dy
            cuts.append(hit[(dy != 0) & (hit > x1) & (hit < x2)])
        for i in range(len(x1) - 1):
            cross = dx[i] * dy[i + 1 :] - dy[i] * dx[i + 1 :]
            shift = (x1[i + 1 :] - x1[i]) * dy[i + 1 :] - (y1[i + 1 :] - y1[i]) * dx[i + 1 :]
            hit = x1[i] + dx[i] * shift / cross
            both = (hit > np.maximum(x1[i], x1[i + 1 :])) & (hit < np.minimum(x2[i], x2[i + 1 :]))
            cuts.append(hit[(cross != 0) & both])
    xs = np.unique(np.concatenate(cuts))
    xs = xs[(xs >= left) & (xs <= right)]
    owners = np.unique(owner)
    column = np.searchsorted(owners, owner)
    for xa, xb in zip(xs[:-1], xs[1:]):
        middle = (xa + xb) / 2
        active = np.flatnonzero((x1 <= middle) & (x2 > middle))
        if not len(active):
            continue
        y = np.clip(y1[active] + (middle - x1[active]) * dy[active] / dx[active], bottom, top)
        order = np.argsort(y, kind="stable")
        rows = active[order]
        gaps = np.diff(np.append(y[order], top))
        marks = np.zeros((len(rows), len(owners)), dtype=np.int64)
        marks[np.arange(len(rows)), column[rows]] = w[rows]
        yield xb - xa, gaps, marks.cumsum(axis=0)


def _cell_areas(key: tuple, frame: Mapping[str, np.ndarray]) -> list[tuple]:
    """Fragment, level, union and own areas of one group in one cell."""
    group, ix, iy, size = key
    bottom, top = iy * size, (iy + 1) * size
    flat, xa, xb = frame["is_below"], frame["xa"], frame["xb"]
    # edges that lie below enter the cell as parts of its lower side
    y1 = np.where(flat, bottom, frame["y1"])
    y2 = np.where(flat, bottom, frame["y2"])
    x1 = np.where(flat, xa, frame["x1"])
    x2 = np.where(flat, xb, frame["x2"])
    names = frame["polygon"]
    owners, owner = np.unique(names, return_inverse=True)
    level_of = dict(zip(names, frame["level"]))
    levels = np.array([level_of[o] for o in owners], dtype=object)
    is_clip = owners == ""
    w = frame["w"]
    area = np.zeros(len(owners))
    low, high = np.zeros(len(owners), dtype=int), np.zeros(len(owners), dtype=int)
    by_level = {name: 0.0 for name in set(levels[~is_clip])}
    union = clip_area = nonzero = 0.0
    for width, gaps, turns in sweep_cell(
        x1, y1, x2, y2, w, owner, ix * size, (ix + 1) * size, bottom, top
    ):
        here = gaps * width
        solid = here > 0
        if solid.any():
            low, high = np.minimum(low, turns[solid].min(axis=0)), np.maximum(high, turns[solid].max(axis=0))
        inside = turns % 2 != 0
        clip = inside[:, is_clip].any(axis=1) if is_clip.any() else np.ones(len(here), dtype=bool)
        clip_area += here[clip].sum()
        weighted = np.where(clip, here, 0.0)
        area += weighted @ inside
        nonzero += weighted @ (turns[:, ~is_clip] != 0).any(axis=1)
        for name in by_level:
            by_level[name] += weighted @ inside[:, (levels == name) & ~is_clip].any(axis=1)
        union += weighted @ inside[:, ~is_clip].any(axis=1)
    rows = [
        (group, levels[i], owners[i], "POLYGON", area[i], low[i], high[i])
        for i in range(len(owners))
        if not is_clip[i]
    ]
    rows += [(group, name, None, "LEVEL", value, 0, 0) for name, value in by_level.items()]
    rows += [(group, None, None, "UNION", union, 0, 0), (group, None, None, "NONZERO", nonzero, 0, 0)]
    if is_clip.any():
        rows.append((group, None, None, "CLIP", clip_area, 0, 0))
    return rows


def _sorted_cell_areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The areas of all cells of a task, whose rows come cell by cell; one batch out for each batch in."""
    kinds = {"xa": float, "xb": float, "x1": float, "y1": float, "x2": float, "y2": float, "w": np.int64, "is_below": bool}
    schema = pa.schema(
        [(n, pa.string()) for n in ("grp", "level", "polygon", "kind")]
        + [("area", pa.float64()), ("low_turn", pa.int32()), ("high_turn", pa.int32())]
    )
    cell = ("grp", "ix", "iy", "size")

    def columns_of(table: pa.Table) -> dict[str, np.ndarray]:
        found = {n: table.column(n).to_numpy().astype(kind) for n, kind in kinds.items()}
        found["polygon"] = np.array([n or "" for n in table.column("polygon").to_pylist()], dtype=object)
        found["level"] = np.array(table.column("level").to_pylist(), dtype=object)
        return found

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    held = None  # the rows of the last cell, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        marks = list(zip(*(table.column(n).to_pylist() for n in cell)))
        starts = [i for i, mark in enumerate(marks) if i == 0 or mark != marks[i - 1]]
        columns = columns_of(table.slice(0, starts[-1]))
        rows = []
        for a, b in zip(starts, starts[1:]):
            rows += _cell_areas(marks[a], {n: values[a:b] for n, values in columns.items()})
        held = table.slice(starts[-1])
        if rows:
            yield out(rows)
    if held is not None:
        mark = tuple(held.column(n)[0].as_py() for n in cell)
        yield out(_cell_areas(mark, columns_of(held)))


def _by_cells(spread, size: float, limit: int, factor: int = 8) -> DataFrame:
    """Pieces per group and cell, with crowded cells cut again into smaller ones.

    ``spread(cell, involved)`` cuts edges into cells of one size, only those of the given
    (grp, polygon) pairs when there are any. Cells are independent, so cutting some of
    them finer leaves every sum as it is. ``factor`` is a power of two, so the small cells
    tile the large one exactly. A cell is crowded by the edges that touch it, not by what
    lies below. A cell is cut as long as that halves its edges, so the number of rounds
    follows from the data; lines that lie on each other were merged before, and what stays
    together at any size are lines through one point.
    """
    cell = ["grp", "ix", "iy"]
    unknown = F.lit(None).cast("bigint")
    current = materialize(spread(size, None).withColumn("held", unknown), "pieces")
    done = None
    while True:
        counted = current.groupBy(*cell).agg(
            F.count_if(~F.col("is_below")).alias("n"), F.max("held").alias("before")
        )
        helps = F.col("before").isNull() | (F.col("n") * 2 <= F.col("before"))
        crowded = counted.filter((F.col("n") > limit) & helps).select(*cell, "n")
        if crowded.isEmpty():
            break
        calm = current.join(crowded, cell, "left_anti").select(*current.columns)
        done = calm if done is None else done.unionByName(calm)
        # only what reaches into a crowded cell is cut again
        involved = current.join(crowded, cell, "left_semi").select("grp", "polygon").distinct()
        size = size / factor
        home = crowded.select(
            "grp", F.col("ix").alias("hx"), F.col("iy").alias("hy"), F.col("n").alias("held")
        )
        fine = spread(size, involved).withColumns(
            {"hx": F.floor(F.col("ix") / factor), "hy": F.floor(F.col("iy") / factor)}
        )
        inside = fine.join(home, ["grp", "hx", "hy"])
        current = materialize(inside.select(*current.columns), "pieces")
    return current if done is None else done.unionByName(current)


def _own_cells(rows: DataFrame, group: Column, polygon: Column, keys: Sequence[str], size: float, limit: int) -> DataFrame:
    """Cells of polygons that are measured without a clip region."""
    named = rows.withColumns({"grp": group.cast("string"), "polygon": polygon.cast("string")}).drop(
        *[k for k in keys if k not in ("grp", "polygon")]
    )
    named = merged_lines(named, ["grp", "polygon"])
    # the row keeps its own copy, so both branches of a refinement read the same edges
    named = materialize(named, "edges")

    def spread(cell: float, involved) -> DataFrame:
        chosen = named if involved is None else named.join(involved, ["grp", "polygon"], "left_semi")
        return cut(chosen, ["grp", "polygon"], cell).withColumns(
            {"level": F.lit("-"), "size": F.lit(float(cell))}
        )

    return _by_cells(spread, size, limit)


def _areas(pieces: DataFrame) -> DataFrame:
    """Sum the cell areas; ``pieces`` has grp, ix, iy, size, polygon, level and the edge columns."""
    wide = pieces.filter((F.col("xa") < F.col("xb")) & (F.col("w") != 0))
    # cells are many and small: a task goes through its sorted rows instead of being called for each cell
    cell = ("grp", "ix", "iy", "size")
    dealt = wide.select(*cell, "polygon", "level", *PART).repartition(busy_tasks(pieces.sparkSession), *cell)
    dealt = dealt.sortWithinPartitions(*cell)
    cells = dealt.mapInArrow(_sorted_cell_areas, AREA_SCHEMA)
    return cells.groupBy("grp", "level", "polygon", "kind").agg(
        F.sum("area").alias("area"), F.min("low_turn").alias("low_turn"), F.max("high_turn").alias("high_turn")
    )


def measure_polygons(polygons: DataFrame, key: str, size: float, transform=None, limit: int = 2000) -> DataFrame:
    """Even-odd area, non-zero area and turning range of each polygon, cell by cell.

    Oriented rings of a valid polygon turn 0 or 1 time around every point; any other
    number shows a crossing or an overlap inside the polygon.
    """
    pieces = _own_cells(edges(polygons, [key], transform), F.col(key), F.col(key), [key], size, limit)
    summed = _areas(pieces)
    kind = F.col("kind")
    return summed.groupBy(F.col("grp").alias(key)).agg(
        F.sum(F.when(kind == "UNION", F.col("area"))).alias("even_odd_area"),
        F.sum(F.when(kind == "NONZERO", F.col("area"))).alias("nonzero_area"),
        F.min("low_turn").alias("low_turn"), F.max("high_turn").alias("high_turn"),
    ).withColumn("turns_once", (F.col("low_turn") >= 0) & (F.col("high_turn") <= 1))


def union_area(
    polygons: DataFrame, group: str, polygon_id: str, size: float, transform=None, limit: int = 2000,
    turns_once: bool = False,
) -> DataFrame:
    """Dissolved area of all polygons of a group: a spatial union aggregate, cell by cell.

    Equal shapes of a group are swept once. ``turns_once`` says that every polygon is known
    to turn 0 or 1 times around every point (see ``measure_polygons``). Turns then add up
    over polygons, so a group is one owner whose edges are merged on each line: borders that
    neighbours share vanish, and a cell holds as many edges as it has different lines.
    """
    shapes = polygons.select(group, polygon_id, "rings", shape_mark(F.col("rings")).alias("mark"))
    shapes = shapes.groupBy(group, "mark").agg(F.min(polygon_id).alias(polygon_id), F.any_value("rings").alias("rings"))
    rows = edges(shapes, [group, polygon_id], transform)
    owner = F.lit("all") if turns_once else F.col(polygon_id)
    pieces = _own_cells(rows, F.col(group), owner, [group, polygon_id], size, limit)
    kind = "NONZERO" if turns_once else "UNION"
    return _areas(pieces).filter(F.col("kind") == kind).groupBy(F.col("grp").alias(group)).agg(
        F.sum("area").alias("union_area")
    )


def accept_repair(area: Column, declared: Column, ratio: float, absolute: float) -> Column:
    """A repaired area is kept within the larger of a relative and an absolute tolerance."""
    return F.coalesce(
        (declared > 0) & (F.abs(area - declared) <= F.greatest(declared * ratio, F.lit(absolute))), F.lit(False)
    )


def overlay_area(
    polygons: DataFrame, regions: DataFrame, size: float, transform=None, refine_over: int = 2000
) -> DataFrame:
    """Areas of polygons inside regions, per level and over all levels.

    ``polygons`` has polygon_id, level, rings; ``regions`` has region, rings. Output per
    region and level: fragment sum, dissolved area, polygon count; per region its own
    area and the union over levels.

    Equal geometries of one level are swept once and counted by their number, so copies
    cost nothing. A cell with more than ``refine_over`` edges is cut again into smaller
    cells; cells are independent, so the sum stays exact.
    """
    copies = (
        polygons.select("polygon_id", "level", "rings", shape_mark(F.col("rings")).alias("mark"))
        .groupBy("level", "mark")
        .agg(
            F.count(F.lit(1)).alias("copies"), F.min("polygon_id").cast("string").alias("polygon"),
            F.any_value("rings").alias("rings"),
        )
    )
    copies = materialize(copies, "shapes")
    shape_edges = materialize(
        merged_lines(
            edges(copies.select("polygon", "level", "rings"), ["polygon", "level"], transform), ["polygon", "level"]
        ),
        "shape-edges",
    )
    clip_edges = materialize(
        merged_lines(edges(regions.select(F.col("region").alias("grp"), "rings"), ["grp"], transform), ["grp"]),
        "clip-edges",
    )

    def spread(cell: float, involved) -> DataFrame:
        shapes_now, clips_now = shape_edges, clip_edges
        if involved is not None:
            shapes_now = shape_edges.join(involved.select("polygon").distinct(), "polygon", "left_semi")
            clips_now = clip_edges.join(involved.select("grp").distinct(), "grp", "left_semi")
        none = F.lit(None).cast("string")
        clip = cut(clips_now, ["grp"], cell).withColumns({"polygon": none, "level": none})
        where = clip.select("grp", "ix", "iy").distinct()
        inside = cut(shapes_now, ["polygon", "level"], cell).join(where, ["ix", "iy"])
        return clip.unionByName(inside).withColumn("size", F.lit(float(cell)))

    summed = materialize(_areas(_by_cells(spread, size, refine_over)), "areas")
    counted = summed.join(copies.select("polygon", "copies"), "polygon", "left")
    kind, area = F.col("kind"), F.col("area")
    hit = (kind == "POLYGON") & (area > 0)
    per_level = counted.filter(kind.isin("POLYGON", "LEVEL")).groupBy(F.col("grp").alias("region"), "level").agg(
        F.sum(F.when(hit, F.col("copies")).otherwise(0)).alias("source_polygon_count"),
        F.sum(F.when(kind == "POLYGON", area * F.col("copies"))).alias("fragment_area"),
        F.sum(F.when(kind == "LEVEL", area)).alias("dissolved_area"),
    )
    per_region = counted.groupBy(F.col("grp").alias("region")).agg(
        F.sum(F.when(kind == "UNION", area)).alias("union_area"),
        F.sum(F.when(kind == "CLIP", area)).alias("region_area"),
    )
    return per_level.filter("source_polygon_count > 0").join(per_region, "region", "right")


def overlaps(areas: DataFrame, unit: float = 1e6) -> DataFrame:
    """Overlap within a level and across levels, in square kilometres, unrounded (GEO10)."""
    measured = areas.select(
        "region", "level", "source_polygon_count",
        (F.col("dissolved_area") / unit).alias("susceptible_area"),
        (F.col("region_area") / unit).alias("region_area"),
        ((F.col("fragment_area") - F.col("dissolved_area")) / unit).alias("within_level_overlap"),
        F.col("dissolved_area"), F.col("union_area"),
    )
    levels = measured.groupBy("region").agg(
        ((F.sum("dissolved_area") - F.max("union_area")) / unit).alias("cross_level_overlap")
    )
    return measured.drop("dissolved_area", "union_area").join(levels, "region", "left")


def exposure_grid(
    members: DataFrame, levels: DataFrame, measured: DataFrame, tolerance: float = 0.01
) -> DataFrame:
    """Complete region x level grid: real zeros in safe regions, NULL elsewhere (GEO11).

    ``members`` has region and boundary_status. Values are rounded once, here, and
    nothing is clamped; additivity compares the unrounded overlap.
    """
    safe = F.col("boundary_status") == "VALID_REGION_BOUNDARY"
    per_level = measured.filter("level is not null").select(
        "region", "level", "susceptible_area", "within_level_overlap", "source_polygon_count",
        F.lit(True).alias("__hit"),
    )
    per_region = measured.groupBy("region").agg(
        F.max("region_area").alias("__own"), F.max("cross_level_overlap").alias("__cross")
    )
    grid = members.crossJoin(levels).join(per_level, ["region", "level"], "left").join(per_region, "region", "left")
    zero = F.lit(0.0)
    amount = lambda c: F.when(safe, F.round(F.coalesce(F.col(c), zero), 4)).cast("decimal(18,4)")
    cross = F.coalesce(F.col("__cross"), zero)
    share = F.when(F.col("__own") != 0, 100 * F.coalesce(F.col("susceptible_area"), zero) / F.col("__own"))
    hit = F.col("__hit").isNotNull()
    return grid.select(
        "region", "level", "boundary_status",
        F.when(safe, F.round("__own", 4)).cast("decimal(18,4)").alias("region_area_sqkm"),
        amount("susceptible_area").alias("susceptible_area_sqkm"),
        F.when(safe, F.round(share, 4)).cast("decimal(7,4)").alias("share_of_region_area_pct"),
        F.when(safe, F.coalesce("source_polygon_count", F.lit(0))).alias("source_polygon_count"),
        amount("within_level_overlap").alias("within_level_overlap_sqkm"),
        amount("__cross").alias("cross_level_overlap_sqkm"),
        F.when(~safe, "NOT_EVALUATED")
        .when(cross > tolerance, "NON_ADDITIVE_CROSS_LEVEL_OVERLAP")
        .otherwise("ADDITIVE_WITHIN_TOLERANCE")
        .alias("additivity_status"),
        F.when(~safe, "NO_SAFE_REGION_BOUNDARY").when(hit, "CALCULATED").otherwise("NO_MAPPED_EXPOSURE").alias(
            "spatial_match_status"
        ),
    )


# --- boundaries ---------------------------------------------------------------------

def assess_boundaries(
    members: DataFrame, boundaries: DataFrame, features: DataFrame, membership: DataFrame
) -> DataFrame:
    """Whether each region's boundary may be used (GEO12).

    ``members`` has region; ``boundaries`` has region and is_valid per feature;
    ``features`` has area and region as the boundary set places them; ``membership`` has
    area and region as they are now. Territory is compared both ways: areas that moved or
    vanished, and current areas the boundary set lacks.
    """
    counted = boundaries.groupBy("region").agg(
        F.count(F.lit(1)).alias("boundary_feature_count"), F.bool_and("is_valid").alias("__valid")
    )
    now = membership.select("area", F.col("region").alias("now"))
    placed = features.select("area", "region").distinct()
    left = (
        placed.join(now, "area", "left")
        .filter(~F.col("now").eqNullSafe(F.col("region")))
        .select("region", F.concat("area", F.lit(" now "), F.coalesce("now", F.lit("unlisted"))).alias("detail"))
    )
    joined = membership.join(placed.select("area"), "area", "left_anti").select(
        "region", F.concat("area", F.lit(" missing from boundary")).alias("detail")
    )
    moved = left.unionByName(joined).groupBy("region").agg(
        F.count(F.lit(1)).alias("territory_difference_count"),
        F.concat_ws("; ", F.sort_array(F.collect_set("detail"))).alias("territory_difference_details"),
    )
    rows = members.join(counted, "region", "left").join(moved, "region", "left")
    count = F.coalesce("boundary_feature_count", F.lit(0))
    differences = F.coalesce("territory_difference_count", F.lit(0))
    status = (
        F.when(count == 0, "NO_SAFE_REGION_BOUNDARY")
        .when(count > 1, "AMBIGUOUS_REGION_BOUNDARY")
        .when(~F.coalesce("__valid", F.lit(False)), "INVALID_REGION_GEOMETRY")
        .when(differences > 0, "BOUNDARY_TERRITORY_MISMATCH")
        .otherwise("VALID_REGION_BOUNDARY")
    )
    return rows.withColumns(
        {"boundary_feature_count": count, "territory_difference_count": differences, "boundary_status": status}
    ).drop("__valid")


def boundary_status(areas: DataFrame, boundaries: DataFrame) -> DataFrame:
    """One boundary per area with an explicit status (GEO13).

    ``areas`` has code and area_type, ``boundaries`` has code and is_valid, one row per feature.
    """
    counted = boundaries.groupBy("code").agg(
        F.count(F.lit(1)).alias("boundary_candidate_count"), F.count_if("is_valid").alias("__valid")
    )
    joined = areas.join(counted, "code", "left")
    count = F.coalesce("boundary_candidate_count", F.lit(0))
    status = (
        F.when(F.col("area_type") == "UNKNOWN", "NOT_APPLICABLE")
        .when(count == 0, "MISSING_BOUNDARY")
        .when(count > 1, "AMBIGUOUS_BOUNDARY")
        .when(F.col("__valid") == 0, "INVALID_BOUNDARY")
        .otherwise("VALID_BOUNDARY")
    )
    return joined.withColumns({"boundary_candidate_count": count, "boundary_status": status}).drop("__valid")


# --- storage --------------------------------------------------------------------------

def to_wkb(rings: Column) -> Column:
    """Little-endian WKB polygon of the rings, in Arrow batches."""

    @F.pandas_udf("binary")
    def encode(column: pd.Series) -> pd.Series:
        def one(value):
            if value is None:
                return None
            parts = [struct.pack("<BII", 1, 3, len(value))]
            for ring in value:
                flat = np.array([list(p) for p in ring], dtype="<f8")
                parts += [struct.pack("<I", len(flat)), flat.tobytes()]
            return b"".join(parts)

        return column.map(one)

    return encode(rings)


def from_wkb(wkb: Column) -> Column:
    """Rings of a little-endian WKB polygon."""

    @F.pandas_udf(POLYGON)
    def decode(column: pd.Series) -> pd.Series:
        def one(value):
            if value is None:
                return None
            _, _, count = struct.unpack_from("<BII", value, 0)
            offset, rings = 9, []
            for _ in range(count):
                (size,) = struct.unpack_from("<I", value, offset)
                flat = np.frombuffer(value, dtype="<f8", count=2 * size, offset=offset + 4)
                rings.append(flat.reshape(size, 2).tolist())
                offset += 4 + 16 * size
            return rings

        return column.map(one)

    return decode(wkb)
