"""Spatial operators and placement on the supplied tables (GEO*, JOIN09, JOIN10, MAT11-MAT15, DQ09-DQ12)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from verigrid.functions import geometry
from verigrid.functions.text import standardize
from verigrid.operators import matching, spatial
from verigrid.plans import quality
from verigrid.queries.quality import check_rows, n_if, shown
from verigrid.queries.registry import query
from verigrid.sinks.stage import materialize

CELL = 2.0


def point(x, y):
    return F.array(F.lit(x).cast("double") if not hasattr(x, "cast") else x.cast("double"), F.lit(y).cast("double") if not hasattr(y, "cast") else y.cast("double"))


def ring(*points):
    return F.array(*[point(x, y) for x, y in points])


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


def nation_polygons(t):
    """A square, a triangle or a square with a hole per nation; neighbours overlap."""
    n = F.col("n_nationkey")
    x = n * 4
    square = box(x, F.lit(0), x + 4.5, F.lit(9))
    triangle = ring((x, F.lit(0)), (x + 4.5, F.lit(0)), (x + 2.25, F.lit(9)), (x, F.lit(0)))
    hole = ring((x + 1, F.lit(3)), (x + 1, F.lit(6)), (x + 3, F.lit(6)), (x + 3, F.lit(3)), (x + 1, F.lit(3)))
    rings = F.when(n < 15, F.array(square)).when(n < 20, F.array(triangle)).otherwise(F.array(square, hole))
    return t.nation.select("n_nationkey", "n_regionkey", rings.alias("rings"))


def customer_points(t):
    return t.customer.select(
        "c_custkey", (F.col("c_nationkey") * 4 + (F.col("c_custkey") % 97) / 16).alias("x"), (F.col("c_acctbal") / 1000).alias("y")
    )


COVER_SQL = """
    pts AS (SELECT c_custkey, c_nationkey * 4 + (c_custkey % 97) / 16 AS px, c_acctbal / 1000 AS py FROM customer),
    corner(kind, rid, i, dx, y) AS (VALUES ('s',0,0,0.0,0.0),('s',0,1,4.5,0.0),('s',0,2,4.5,9.0),('s',0,3,0.0,9.0),('s',0,4,0.0,0.0),('t',0,0,0.0,0.0),('t',0,1,4.5,0.0),('t',0,2,2.25,9.0),('t',0,3,0.0,0.0),('h',1,0,1.0,3.0),('h',1,1,1.0,6.0),('h',1,2,3.0,6.0),('h',1,3,3.0,3.0),('h',1,4,1.0,3.0)),
    vert AS (SELECT n_nationkey, n_regionkey, rid, i, n_nationkey * 4 + CAST(dx AS DOUBLE) AS vx, CAST(y AS DOUBLE) AS vy FROM nation JOIN corner ON (kind = 's' AND (n_nationkey < 15 OR n_nationkey >= 20)) OR (kind = 't' AND n_nationkey BETWEEN 15 AND 19) OR (kind = 'h' AND n_nationkey >= 20)),
    edge AS (SELECT a.n_nationkey, a.n_regionkey, a.vx AS x1, a.vy AS y1, b.vx AS x2, b.vy AS y2 FROM vert a JOIN vert b ON b.n_nationkey = a.n_nationkey AND b.rid = a.rid AND b.i = a.i + 1),
    cover AS (SELECT c_custkey, n_nationkey, n_regionkey FROM pts CROSS JOIN edge GROUP BY ALL HAVING SUM(CASE WHEN (y1 <= py) <> (y2 <= py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END) % 2 = 1
        OR bool_or((x2 - x1) * (py - y1) = (y2 - y1) * (px - x1) AND px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)))"""


def cover(t, size=CELL):
    return spatial.points_in_polygons(
        customer_points(t), nation_polygons(t), "c_custkey", ["n_nationkey", "n_regionkey"], size
    )


@query("join09", f"WITH {COVER_SQL} SELECT pts.c_custkey, CAST(COUNT(cover.c_custkey) AS BIGINT) AS covering_polygons FROM pts LEFT JOIN cover ON cover.c_custkey = pts.c_custkey GROUP BY 1")
def join09(t):
    counted = cover(t, 25.0).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("covering_polygons"))
    return t.customer.select("c_custkey").join(counted, "c_custkey", "left").withColumn(
        "covering_polygons", F.coalesce("covering_polygons", F.lit(0))
    )


BOX_SQL = """
    boxes AS (SELECT s_suppkey, s_nationkey * 4 + CAST(floor(s_acctbal / 2500) AS INTEGER) AS bx0, s_nationkey * 4 + CAST(floor(s_acctbal / 2500) AS INTEGER) + 2 + s_nationkey // 8 AS bx1, CAST(floor(s_acctbal / 1500) AS INTEGER) AS by0, CAST(floor(s_acctbal / 1500) AS INTEGER) + 3 AS by1,
        CASE WHEN s_acctbal < 2500 THEN 'Low' WHEN s_acctbal < 5000 THEN 'Moderate' ELSE 'High' END AS level FROM supplier)"""


def supplier_boxes(t):
    balance, n = F.col("s_acctbal"), F.col("s_nationkey")
    x0 = n * 4 + F.floor(balance / 2500)
    y0 = F.floor(balance / 1500)
    level = F.when(balance < 2500, "Low").when(balance < 5000, "Moderate").otherwise("High")
    rings = F.array(box(x0, y0, x0 + 2 + F.floor(n / 8), y0 + 3))
    return t.supplier.select("s_suppkey", level.alias("level"), rings.alias("rings"))


@query("join10", f"WITH {COVER_SQL}, {BOX_SQL} SELECT c_custkey, s_suppkey FROM pts JOIN boxes ON px BETWEEN bx0 AND bx1 AND py BETWEEN by0 AND by1")
def join10(t):
    return spatial.points_in_polygons(customer_points(t), supplier_boxes(t), "c_custkey", ["s_suppkey"], 1.0)


def shapes(t):
    """Suppliers as published geometry text in every condition."""
    b, x = F.col("s_acctbal"), F.col("s_nationkey")
    at = lambda dx: (x + dx).cast("string")

    def coordinates(points, quote=""):
        parts = []
        for dx, y in points:
            parts += [F.lit(f"[{quote}"), at(dx), F.lit(f"{quote},{quote}{y}{quote}],")]
        joined = F.concat(*parts)
        return F.concat(F.lit("["), F.rtrim(joined, F.lit(",")), F.lit("]"))

    square = [(0, 0), (2, 0), (2, 3), (0, 3), (0, 0)]
    hole = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
    wrap = lambda kind, body: F.concat(F.lit(f'{{"type":"{kind}","coordinates":['), body, F.lit("]}"))
    def metres(points):
        """The ring on the Mercator plane, as Esri services give it."""
        pairs = [F.concat(F.lit("["), *[c.cast("string") for c in (xy[0], F.lit(","), xy[1])], F.lit("]")) for xy in (geometry.to_mercator(x + dx, F.lit(float(y))) for dx, y in points)]
        return F.concat(F.lit("["), F.concat_ws(",", *pairs), F.lit("]"))

    esri = F.concat(
        F.lit('{"rings":['), metres(list(reversed(square))), F.lit(","), metres(list(reversed(hole))),
        F.lit('],"spatialReference":{"wkid":102100,"latestWkid":3857}}'),
    )
    moved = [(dx + 5, y) for dx, y in square]
    multi = F.concat(F.lit("["), coordinates(square), F.lit("],["), coordinates(moved), F.lit("]"))
    bow_tie = [(0, 0), (2, 2), (2, 0), (0, 4), (0, 0)]
    text = (
        F.when(b < 1000, "  ")
        .when(b < 2000, wrap("Polygon", coordinates(square)))
        .when(b < 3000, wrap("Polygon", coordinates(square, '"')))
        .when(b < 4000, esri)
        .when(b < 5000, F.concat(F.lit('{"type":"Point","coordinates":['), at(0), F.lit(",1]}")))
        .when(b < 6000, '{"type":"Polygon","coordinates":[[[1,')
        .when(b < 7000, wrap("Polygon", coordinates(square[:-1])))
        .when(b < 8000, wrap("MultiPolygon", multi))
        .when(b < 9000, wrap("Polygon", coordinates(bow_tie)))
        .otherwise('{"type":"Polygon","coordinates":[]}')
    )
    declared = F.when(b < 8500, F.lit(3.3)).otherwise(F.lit(5.0))
    return t.supplier.select("s_suppkey", "s_acctbal", text.alias("geometry_json"), declared.alias("declared_area"))


BANDS = "s_acctbal AS b FROM supplier"
STATUS_CASE = """CASE WHEN b < 1000 THEN 'BLANK_GEOMETRY' WHEN b < 4000 THEN 'USABLE_GEOMETRY' WHEN b < 5000 THEN 'UNSUPPORTED_GEOMETRY_TYPE' WHEN b < 6000 THEN 'UNPARSEABLE_GEOMETRY' WHEN b < 7000 THEN 'INVALID_GEOMETRY' WHEN b < 9000 THEN 'USABLE_GEOMETRY' ELSE 'EMPTY_GEOMETRY' END"""


@query(
    "geo01",
    f"""SELECT s_suppkey, CASE WHEN b < 1000 THEN 'NOT_PARSED' WHEN b < 2000 THEN 'GEOJSON_AS_PUBLISHED' WHEN b < 3000 THEN 'GEOJSON_QUOTED_NUMBERS_NORMALIZED' WHEN b < 4000 THEN 'ESRI_JSON_CONVERTED' WHEN b < 6000 THEN 'PARSE_FAILED' ELSE 'GEOJSON_AS_PUBLISHED' END AS geometry_parse_method,
        CASE WHEN b < 1000 OR (b >= 4000 AND b < 6000) THEN NULL WHEN b < 3000 THEN 1 WHEN b < 4000 THEN 2 WHEN b < 7000 THEN 1 WHEN b < 8000 THEN 2 WHEN b < 9000 THEN 1 ELSE 0 END AS ring_count FROM (SELECT s_suppkey, {BANDS})""",
)
def geo01(t):
    parsed = spatial.parse_polygons(shapes(t), "geometry_json")
    return parsed.select("s_suppkey", "geometry_parse_method", F.when(F.col("rings").isNotNull(), F.size("rings")).alias("ring_count"))


@query("geo02", "SELECT s_suppkey, CAST(1 AS BIGINT) AS shells, CAST(1 AS BIGINT) AS holes, CAST(5 AS DOUBLE) AS area FROM supplier WHERE s_acctbal >= 3000 AND s_acctbal < 4000")
def geo02(t):
    parsed = spatial.parse_polygons(shapes(t), "geometry_json").filter("geometry_parse_method = 'ESRI_JSON_CONVERTED'")
    shells, holes = spatial.ring_roles(F.col("rings"))
    return parsed.select(
        "s_suppkey", shells.cast("bigint").alias("shells"), holes.cast("bigint").alias("holes"),
        F.round(geometry.rings_area(F.col("rings")), 9).alias("area"),
    )


@query("geo03", f"SELECT s_suppkey, {STATUS_CASE} AS geometry_status FROM (SELECT s_suppkey, {BANDS})")
def geo03(t):
    return spatial.parse_polygons(shapes(t), "geometry_json").select("s_suppkey", "geometry_status")


def repaired(t):
    """Final status: a usable text whose rings turn more than once is invalid until its measured area is accepted."""
    # the parse is written once; measuring reads it several times
    parsed = materialize(spatial.parse_polygons(shapes(t), "geometry_json"), "parsed")
    usable = parsed.filter("geometry_status = 'USABLE_GEOMETRY'")
    measured = spatial.measure_polygons(usable, "s_suppkey", 4.0).withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))
    joined = parsed.join(measured, "s_suppkey", "left")
    accepted = spatial.accept_repair(F.col("nonzero_area"), F.col("declared_area"), 0.02, 0.05)
    status = F.when(F.col("turns_once").isNull() | F.col("turns_once"), F.col("geometry_status")).when(
        accepted, "REPAIRED_GEOMETRY"
    ).otherwise("INVALID_GEOMETRY")
    return joined.withColumn("final_status", status)


@query(
    "geo04",
    f"""SELECT s_suppkey, CASE WHEN b >= 8000 AND b < 8500 THEN 'REPAIRED_GEOMETRY' WHEN b >= 8500 AND b < 9000 THEN 'INVALID_GEOMETRY' ELSE {STATUS_CASE} END AS final_status,
        CASE WHEN b < 1000 THEN NULL WHEN b < 3000 THEN 6.0 WHEN b < 4000 THEN 5.0 WHEN b < 7000 THEN NULL WHEN b < 8000 THEN 12.0 WHEN b < 9000 THEN ROUND(10.0::DOUBLE / 3, 6) END AS area FROM (SELECT s_suppkey, {BANDS})""",
)
def geo04(t):
    return repaired(t).select("s_suppkey", "final_status", F.round("nonzero_area", 6).alias("area"))


@query("geo05", f"WITH {COVER_SQL} SELECT c_custkey, CAST(COUNT(DISTINCT n_regionkey) AS BIGINT) AS candidate_count, CASE WHEN COUNT(DISTINCT n_regionkey) = 1 THEN MAX(n_regionkey) END AS region FROM cover GROUP BY 1")
def geo05(t):
    found = cover(t).groupBy("c_custkey").agg(
        F.countDistinct("n_regionkey").alias("candidate_count"), F.max("n_regionkey").alias("region")
    )
    return found.withColumn("region", F.when(F.col("candidate_count") == 1, F.col("region")))


@query("geo06", f"WITH {COVER_SQL} SELECT c_custkey, n_nationkey FROM cover")
def geo06(t):
    return cover(t, 0.75).select("c_custkey", "n_nationkey")


@query("geo07", f"WITH {BOX_SQL} SELECT s_suppkey, CAST(bx0 AS DOUBLE) AS xmin, CAST(bx1 AS DOUBLE) AS xmax, CAST(by0 AS DOUBLE) AS ymin, CAST(by1 AS DOUBLE) AS ymax, CASE WHEN bx1 > 180 OR by1 > 90 THEN 'NOT_DEGREES' ELSE 'DEGREES' END AS crs_screen FROM boxes")
def geo07(t):
    boxed = spatial.bounding_box(supplier_boxes(t))
    return boxed.select("s_suppkey", "xmin", "xmax", "ymin", "ymax", spatial.degree_screen().alias("crs_screen"))


E = geometry.WGS84_E
EQUAL_Y = f"(({1 - geometry.WGS84_E2!r} * (sin(radians(%(y)s)) / (1 - {geometry.WGS84_E2!r} * pow(sin(radians(%(y)s)), 2)) + atanh({E!r} * sin(radians(%(y)s))) / {E!r})) * {geometry.WGS84_A / (2 * geometry.EQUAL_AREA_K0)!r})"
EQUAL_X = f"(radians(%(x)s) * {geometry.WGS84_A * geometry.EQUAL_AREA_K0!r})"


@query(
    "geo08",
    f"""WITH {COVER_SQL} SELECT c_custkey, ROUND({geometry.WGS84_A!r} * radians(px), 3) AS mercator_x, ROUND({geometry.WGS84_A!r} * asinh(tan(radians(py))), 3) AS mercator_y, ROUND(px, 6) AS back_x, ROUND(py, 6) AS back_y, ROUND({EQUAL_X % {'x': 'px'}}, 3) AS equal_x, ROUND({EQUAL_Y % {'y': 'py'}}, 3) AS equal_y FROM pts""",
)
def geo08(t):
    points = customer_points(t)
    mx, my = geometry.to_mercator(F.col("x"), F.col("y"))
    projected = points.select("c_custkey", "x", "y", mx.alias("mx"), my.alias("my"))
    bx, by = geometry.from_mercator(F.col("mx"), F.col("my"))
    ex, ey = geometry.to_equal_area(F.col("x"), F.col("y"))
    return projected.select(
        "c_custkey", F.round("mx", 3).alias("mercator_x"), F.round("my", 3).alias("mercator_y"),
        F.round(bx, 6).alias("back_x"), F.round(by, 6).alias("back_y"),
        F.round(ex, 3).alias("equal_x"), F.round(ey, 3).alias("equal_y"),
    )


def region_boxes(t):
    r = F.col("r_regionkey")
    rings = F.array(box(r * 20, F.lit(0), r * 20 + 18, F.lit(8)))
    return t.region.select(F.col("r_name").alias("region"), rings.alias("rings"))


def overlay(t, size=400000.0):
    polygons = supplier_boxes(t).withColumnRenamed("s_suppkey", "polygon_id")
    return spatial.overlay_area(polygons, region_boxes(t), size, geometry.to_equal_area)


OVERLAY_SQL = f"""{BOX_SQL},
    unit AS (SELECT s_suppkey, level, unnest(generate_series(bx0, bx1 - 1)) AS ux, by0, by1 FROM boxes), cells AS (SELECT s_suppkey, level, ux, unnest(generate_series(by0, by1 - 1)) AS uy FROM unit),
    inside AS (SELECT r_name AS region, c.*, ({EQUAL_X % {'x': '(ux + 1)'}} - {EQUAL_X % {'x': 'ux'}}) * ({EQUAL_Y % {'y': '(uy + 1)'}} - {EQUAL_Y % {'y': 'uy'}}) / 1e6 AS km2 FROM cells c JOIN region ON ux >= r_regionkey * 20 AND ux < r_regionkey * 20 + 18 AND uy >= 0 AND uy < 8),
    frag AS (SELECT region, level, COUNT(DISTINCT s_suppkey) AS n, SUM(km2) AS f FROM inside GROUP BY 1, 2), diss AS (SELECT region, level, SUM(km2) AS d FROM (SELECT DISTINCT region, level, ux, uy, km2 FROM inside) GROUP BY 1, 2), uni AS (SELECT region, SUM(km2) AS u FROM (SELECT DISTINCT region, ux, uy, km2 FROM inside) GROUP BY 1),
    own AS (SELECT r_name AS region, ({EQUAL_X % {'x': '18'}} - {EQUAL_X % {'x': '0'}}) * ({EQUAL_Y % {'y': '8'}} - {EQUAL_Y % {'y': '0'}}) / 1e6 AS a FROM region),
    meas AS (SELECT o.region, frag.level, n, f, d, u, a, (SELECT SUM(d) FROM diss x WHERE x.region = o.region) - u AS cross_overlap FROM own o LEFT JOIN frag ON frag.region = o.region LEFT JOIN diss ON diss.region = o.region AND diss.level = frag.level LEFT JOIN uni ON uni.region = o.region)"""


@query("geo09", f"WITH {OVERLAY_SQL} SELECT region, level, CAST(n AS BIGINT) AS source_polygon_count, ROUND(f, 3) AS fragment_sqkm, ROUND(d, 3) AS dissolved_sqkm, ROUND(coalesce(u, 0), 3) AS union_sqkm, ROUND(a, 3) AS region_sqkm FROM meas")
def geo09(t):
    km2 = lambda c, n: F.round(F.col(c) / 1e6, 3).alias(n)
    return overlay(t).select(
        "region", "level", "source_polygon_count", km2("fragment_area", "fragment_sqkm"),
        km2("dissolved_area", "dissolved_sqkm"), km2("union_area", "union_sqkm"), km2("region_area", "region_sqkm"),
    )


@query("geo10", f"WITH {OVERLAY_SQL} SELECT region, level, ROUND(abs(f - d), 3) AS within_level_overlap, ROUND(abs(cross_overlap), 3) AS cross_level_overlap FROM meas")
def geo10(t):
    return spatial.overlaps(overlay(t, 250000.0)).select(
        "region", "level", F.round(F.abs("within_level_overlap"), 3).alias("within_level_overlap"),
        F.round(F.abs("cross_level_overlap"), 3).alias("cross_level_overlap"),
    )


@query("agg13", f"WITH {BOX_SQL}, u AS (SELECT level, unnest(generate_series(bx0, bx1 - 1)) AS ux, by0, by1 FROM boxes), c AS (SELECT DISTINCT level, ux, unnest(generate_series(by0, by1 - 1)) AS uy FROM u) SELECT level, CAST(COUNT(*) AS DOUBLE) AS union_area FROM c GROUP BY 1")
def agg13(t):
    """Area of the union of all polygons per level, without any clip."""
    groups = supplier_boxes(t).withColumnRenamed("level", "grp")
    # boxes turn once, so shared sides add up and inner ones vanish
    return spatial.union_area(groups, "grp", "s_suppkey", 10.0, turns_once=True).select(
        F.col("grp").alias("level"), F.round("union_area", 6).alias("union_area")
    )


LEVELS = [("Low",), ("Moderate",), ("High",), ("Very High",)]
GRID_SQL = f"""{OVERLAY_SQL}, lv(level) AS (VALUES ('Low'), ('Moderate'), ('High'), ('Very High')), mem AS (SELECT r_name AS region, r_name <> 'EUROPE' AS safe FROM region),
    grid AS (SELECT mem.region, lv.level, safe, a, d, f, n, (SELECT MAX(cross_overlap) FROM meas y WHERE y.region = mem.region) AS cx FROM mem CROSS JOIN lv LEFT JOIN (SELECT DISTINCT region, a FROM meas) o ON o.region = mem.region LEFT JOIN (SELECT region, level, d, f, n FROM meas WHERE level IS NOT NULL) m ON m.region = mem.region AND m.level = lv.level)"""


def exposure(t):
    status = F.when(F.col("r_name") == "EUROPE", "BOUNDARY_TERRITORY_MISMATCH").otherwise("VALID_REGION_BOUNDARY")
    members = t.region.select(F.col("r_name").alias("region"), status.alias("boundary_status"))
    levels = t.spark.createDataFrame(LEVELS, "level string")
    return spatial.exposure_grid(members, levels, spatial.overlaps(overlay(t)))


@query(
    "geo11",
    f"""WITH {GRID_SQL} SELECT region, level, CASE WHEN safe THEN ROUND(ROUND(a, 4), 2) END AS region_area, CASE WHEN safe THEN ROUND(ROUND(coalesce(d, 0), 4), 2) END AS susceptible_area, CASE WHEN safe THEN ROUND(100 * coalesce(d, 0) / a, 3) END AS share_pct, CASE WHEN safe THEN CAST(coalesce(n, 0) AS BIGINT) END AS source_polygon_count,
        CASE WHEN NOT safe THEN 'NOT_EVALUATED' WHEN coalesce(cx, 0) > 0.01 THEN 'NON_ADDITIVE_CROSS_LEVEL_OVERLAP' ELSE 'ADDITIVE_WITHIN_TOLERANCE' END AS additivity_status, CASE WHEN NOT safe THEN 'NO_SAFE_REGION_BOUNDARY' WHEN n IS NOT NULL THEN 'CALCULATED' ELSE 'NO_MAPPED_EXPOSURE' END AS spatial_match_status FROM grid""",
)
def geo11(t):
    near = lambda c, n, d: F.round(F.col(c).cast("double"), d).alias(n)
    return exposure(t).select(
        "region", "level", near("region_area_sqkm", "region_area", 2), near("susceptible_area_sqkm", "susceptible_area", 2),
        near("share_of_region_area_pct", "share_pct", 3), "source_polygon_count", "additivity_status", "spatial_match_status",
    )


@query(
    "geo12",
    """WITH m AS (SELECT r_name AS region, r_regionkey AS rk FROM region), b AS (SELECT CASE WHEN s_acctbal > 9000 THEN r_name END AS region, s_acctbal < 9800 AS ok FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    cnt AS (SELECT region, COUNT(*) AS n, bool_and(ok) AS ok FROM b WHERE region IS NOT NULL GROUP BY 1), placed AS (SELECT DISTINCT n_name AS area, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = CASE WHEN n_nationkey = 6 THEN 2 ELSE n_regionkey END),
    now AS (SELECT n_name AS area, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey), df AS (SELECT p.region, concat(p.area, ' now ', coalesce(now.region, 'unlisted')) AS x FROM placed p LEFT JOIN now ON now.area = p.area WHERE now.region IS DISTINCT FROM p.region UNION ALL SELECT region, concat(area, ' missing from boundary') FROM now WHERE area NOT IN (SELECT area FROM placed)),
    dd AS (SELECT region, COUNT(*) AS k, string_agg(DISTINCT x, '; ' ORDER BY x) AS det FROM df GROUP BY 1)
    SELECT m.region, CAST(coalesce(n, 0) AS BIGINT) AS boundary_feature_count, CAST(coalesce(k, 0) AS BIGINT) AS territory_difference_count, det AS territory_difference_details, CASE WHEN coalesce(n, 0) = 0 THEN 'NO_SAFE_REGION_BOUNDARY' WHEN n > 1 THEN 'AMBIGUOUS_REGION_BOUNDARY' WHEN NOT ok THEN 'INVALID_REGION_GEOMETRY' WHEN k > 0 THEN 'BOUNDARY_TERRITORY_MISMATCH' ELSE 'VALID_REGION_BOUNDARY' END AS boundary_status FROM m LEFT JOIN cnt ON cnt.region = m.region LEFT JOIN dd ON dd.region = m.region""",
)
def geo12(t):
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    used = t.supplier.join(named, F.col("s_nationkey") == F.col("n_nationkey"))
    boundaries = used.filter("s_acctbal > 9000").select(F.col("r_name").alias("region"), (F.col("s_acctbal") < 9800).alias("is_valid"))
    moved = F.when(F.col("n_nationkey") == 6, 2).otherwise(F.col("n_regionkey"))
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", moved.alias("r"))
    features = placed.join(t.region, F.col("r") == F.col("r_regionkey")).select(F.col("n_name").alias("area"), F.col("r_name").alias("region"))
    membership = named.select(F.col("n_name").alias("area"), F.col("r_name").alias("region"))
    members = t.region.select(F.col("r_name").alias("region"))
    return spatial.assess_boundaries(members, boundaries, features, membership)


@query(
    "geo13",
    """WITH b AS (SELECT s_nationkey AS code, COUNT(*) AS n, COUNT(*) FILTER (WHERE s_acctbal > 3000) AS ok FROM supplier WHERE s_acctbal > 1500 GROUP BY 1)
    SELECT n_nationkey AS code, CASE WHEN n_nationkey = 0 THEN 'UNKNOWN' ELSE 'PROVINCE' END AS area_type, CAST(coalesce(n, 0) AS BIGINT) AS boundary_candidate_count, CASE WHEN n_nationkey = 0 THEN 'NOT_APPLICABLE' WHEN coalesce(n, 0) = 0 THEN 'MISSING_BOUNDARY' WHEN n > 1 THEN 'AMBIGUOUS_BOUNDARY' WHEN ok = 0 THEN 'INVALID_BOUNDARY' ELSE 'VALID_BOUNDARY' END AS boundary_status FROM nation LEFT JOIN b ON code = n_nationkey""",
)
def geo13(t):
    areas = t.nation.select(
        F.col("n_nationkey").alias("code"), F.when(F.col("n_nationkey") == 0, "UNKNOWN").otherwise("PROVINCE").alias("area_type")
    )
    features = t.supplier.filter("s_acctbal > 1500").select(F.col("s_nationkey").alias("code"), (F.col("s_acctbal") > 3000).alias("is_valid"))
    return spatial.boundary_status(areas, features)


@query("geo14", f"WITH {BOX_SQL} SELECT s_suppkey, (bx0 + bx1) / 2 AS centroid_x, (by0 + by1) / 2 AS centroid_y FROM boxes")
def geo14(t):
    x, y = geometry.centroid(F.col("rings"))
    return supplier_boxes(t).select("s_suppkey", F.round(x, 9).alias("centroid_x"), F.round(y, 9).alias("centroid_y"))


@query("geo15", "SELECT s_suppkey, CAST(1 AS BIGINT) AS ring_count, CAST(4326 AS BIGINT) AS srid, TRUE AS same_after_rebuild FROM supplier")
def geo15(t):
    """Rings stored as WKB beside their SRID, and back to rings."""
    stored = supplier_boxes(t).select(
        "s_suppkey", "rings", spatial.to_wkb(F.col("rings")).alias("wkb"), F.lit(4326).cast("bigint").alias("srid")
    )
    back = stored.withColumn("back", spatial.from_wkb(F.col("wkb")))
    return back.select(
        "s_suppkey", F.size("back").cast("bigint").alias("ring_count"), "srid",
        (F.col("back") == F.col("rings")).alias("same_after_rebuild"),
    )


@query("geo16", f"WITH {COVER_SQL} SELECT CAST(floor(py * 10) AS BIGINT) AS cell_lat, CAST(floor(px * 10) AS BIGINT) AS cell_lon, CAST(COUNT(*) AS BIGINT) AS points FROM pts GROUP BY 1, 2")
def geo16(t):
    return customer_points(t).groupBy(
        geometry.grid_cell(F.col("y"), 10).alias("cell_lat"), geometry.grid_cell(F.col("x"), 10).alias("cell_lon")
    ).agg(F.count(F.lit(1)).alias("points"))


# --- placement ------------------------------------------------------------------------

PLACE_SQL = f"""{COVER_SQL},
    who AS (SELECT c_custkey, c_acctbal AS bal, c_mktsegment AS seg, CAST(c_acctbal AS DECIMAL(18,2)) AS money, n_nationkey AS n, r_name, r_regionkey AS r, CASE WHEN c_mktsegment = 'MACHINERY' THEN r_name WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('REGION OF ', r_name) WHEN c_mktsegment = 'FURNITURE' THEN r_name WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_acctbal > 5000 THEN 'CENTRAL OFFICE' ELSE r_name END END AS name_std,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 500 THEN 'MISSING_PAIR' ELSE 'VALID_PAIR' END AS coordinate_status FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
    alias(a, target) AS (VALUES ('REGION OF ASIA', 2), ('REGION OF AFRICA', 0), ('REGION OF EUROPE', 3), ('REGION OF EUROPE', 2)),
    sp AS (SELECT cover.c_custkey, COUNT(DISTINCT n_regionkey) AS sn, MAX(n_regionkey) AS st FROM cover JOIN who ON who.c_custkey = cover.c_custkey WHERE coordinate_status = 'VALID_PAIR' AND name_std IS DISTINCT FROM 'CENTRAL OFFICE' GROUP BY 1),
    ev AS (SELECT w.*, CASE WHEN bal > 9500 THEN 1 ELSE 0 END AS mn, CASE WHEN w.r_name = name_std THEN 1 ELSE 0 END AS en, (SELECT COUNT(DISTINCT target) FROM alias WHERE a = name_std) AS an, (SELECT MAX(target) FROM alias WHERE a = name_std) AS at0, coalesce(sn, 0) AS sn, CASE WHEN sn = 1 THEN st END AS st FROM who w LEFT JOIN sp ON sp.c_custkey = w.c_custkey),
    dec AS (SELECT *, CASE WHEN name_std = 'CENTRAL OFFICE' THEN 'NON_GEOGRAPHIC_RULE' WHEN mn > 0 THEN 'MANUAL_OVERRIDE' WHEN en > 0 THEN 'EXACT_REGION_NAME' WHEN an > 0 THEN 'APPROVED_REGION_ALIAS' WHEN sn > 0 THEN 'COORDINATE_BOUNDARY' ELSE 'NONE' END AS mapping_method,
        CASE WHEN name_std = 'CENTRAL OFFICE' THEN NULL WHEN mn > 0 THEN 0 WHEN en > 0 THEN r WHEN an > 0 THEN CASE WHEN an = 1 THEN at0 END ELSE st END AS accepted_target, CASE WHEN name_std = 'CENTRAL OFFICE' THEN 0 WHEN mn > 0 THEN 1 WHEN en > 0 THEN 1 WHEN an > 0 THEN an ELSE sn END AS cc FROM ev),
    cls AS (SELECT *, CASE WHEN mapping_method = 'NON_GEOGRAPHIC_RULE' THEN 'NON_GEOGRAPHIC' WHEN cc > 1 THEN 'AMBIGUOUS' WHEN accepted_target IS NULL THEN 'UNMATCHED' WHEN mapping_method IN ('MANUAL_OVERRIDE', 'EXACT_REGION_NAME', 'APPROVED_REGION_ALIAS') AND sn = 1 AND accepted_target <> st THEN 'MATCHED_WITH_CONFLICT' ELSE 'MATCHED' END AS match_status FROM dec)"""


class Placement:
    """Customers as projects with every kind of evidence for their region."""

    def __init__(self, t, size=CELL):
        named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
            t.region, F.col("n_regionkey") == F.col("r_regionkey")
        )
        segment, balance, name = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("r_name")
        reported = (
            F.when(segment == "MACHINERY", name)
            .when(segment == "AUTOMOBILE", F.concat(F.lit("Region  of "), name))
            .when(segment == "FURNITURE", F.concat(F.lit(" "), F.lower(name), F.lit(" ")))
            .when((segment == "BUILDING") & (balance > 5000), "Central Office")
            .when(segment == "BUILDING", name)
        )
        missing = (segment == "HOUSEHOLD") & (balance < 500)
        self.rows = named.select(
            "c_custkey", "c_acctbal", standardize(reported).alias("name_std"),
            balance.cast("decimal(18,2)").alias("money"),
            F.when(missing, "MISSING_PAIR").otherwise("VALID_PAIR").alias("coordinate_status"),
        )
        geographic = self.rows.filter(~F.col("name_std").eqNullSafe("CENTRAL OFFICE"))
        aliases = t.spark.createDataFrame(
            [("REGION OF ASIA", 2), ("REGION OF AFRICA", 0), ("REGION OF EUROPE", 3), ("REGION OF EUROPE", 2)], "name_std string, target int"
        )
        self.manual = self.rows.filter("c_acctbal > 9500").select("c_custkey", F.lit(0).alias("target"))
        self.exact = geographic.join(
            t.region.select(F.col("r_name").alias("name_std"), F.col("r_regionkey").alias("target")), "name_std"
        ).select("c_custkey", "target")
        self.alias = geographic.join(aliases, "name_std").select("c_custkey", "target")
        located = geographic.filter("coordinate_status = 'VALID_PAIR'").select("c_custkey")
        covered = materialize(cover(t, size), "cover")
        self.spatial = covered.join(located, "c_custkey").select("c_custkey", F.col("n_regionkey").alias("target"))

    def candidates(self):
        return {"manual": self.manual, "exact": self.exact, "alias": self.alias, "spatial": self.spatial}

    def region_map(self):
        return matching.precedence(
            self.rows, self.candidates(), "c_custkey", F.col("name_std") == "CENTRAL OFFICE",
            {
                "manual": ("MANUAL_OVERRIDE", "REVIEWED"), "exact": ("EXACT_REGION_NAME", "EXACT"),
                "alias": ("APPROVED_REGION_ALIAS", "APPROVED_ALIAS"), "spatial": ("COORDINATE_BOUNDARY", "SPATIAL"),
            },
            "spatial", F.col("coordinate_status") == "VALID_PAIR", F.col("name_std").isNull(),
        )


@query(
    "mat11",
    f"""WITH {PLACE_SQL} SELECT c_custkey, mapping_method, CAST(accepted_target AS BIGINT) AS accepted_target, CAST(cc AS BIGINT) AS candidate_count, match_status,
        CASE WHEN mapping_method IN ('NON_GEOGRAPHIC_RULE', 'MANUAL_OVERRIDE') THEN 'REVIEWED' WHEN mapping_method = 'EXACT_REGION_NAME' THEN 'EXACT' WHEN mapping_method = 'APPROVED_REGION_ALIAS' THEN 'APPROVED_ALIAS' WHEN mapping_method = 'COORDINATE_BOUNDARY' AND cc = 1 THEN 'SPATIAL' WHEN cc > 1 THEN 'REVIEW_REQUIRED' ELSE 'UNRESOLVED' END AS match_quality,
        CASE WHEN mapping_method = 'NON_GEOGRAPHIC_RULE' THEN 'NOT_APPLICABLE_NON_GEOGRAPHIC' WHEN coordinate_status <> 'VALID_PAIR' THEN 'NOT_AVAILABLE' WHEN sn = 0 THEN 'NO_BOUNDARY_MATCH' WHEN sn > 1 THEN 'AMBIGUOUS_BOUNDARY' WHEN accepted_target = st THEN 'REGION_MATCH' WHEN accepted_target IS NOT NULL THEN 'REGION_MISMATCH' ELSE 'SPATIAL_ONLY' END AS coordinate_crosscheck FROM cls""",
)
def mat11(t):
    return Placement(t).region_map().select(
        "c_custkey", "mapping_method", F.col("accepted_target").cast("bigint").alias("accepted_target"), "candidate_count",
        "match_status", "match_quality", "coordinate_crosscheck",
    )


@query(
    "mat12",
    f"""WITH {PLACE_SQL}, d AS (SELECT *, CASE WHEN name_std = 'CENTRAL OFFICE' THEN 'NON_GEOGRAPHIC' WHEN mn = 1 THEN 'MANUAL_EXCEPTION' WHEN an = 1 THEN 'APPROVED_ALIAS' WHEN sn = 1 THEN 'COORDINATE_BOUNDARY' ELSE 'NONE' END AS m FROM ev),
    k AS (SELECT *, CASE m WHEN 'MANUAL_EXCEPTION' THEN 1 WHEN 'APPROVED_ALIAS' THEN at0 + 1 WHEN 'COORDINATE_BOUNDARY' THEN st + 1 ELSE 0 END AS area_key FROM d),
    c AS (SELECT *, area_key <> 0 AND ((en = 1 AND r + 1 <> area_key) OR (sn = 1 AND st + 1 <> area_key) OR sn > 1) AS conflict_flag FROM k)
    SELECT c_custkey, m AS mapping_method, CAST(area_key AS BIGINT) AS area_key, conflict_flag, CASE WHEN m = 'NON_GEOGRAPHIC' THEN 'NON_GEOGRAPHIC' WHEN area_key <> 0 AND conflict_flag THEN 'MATCHED_WITH_CONFLICT' WHEN area_key <> 0 THEN 'MATCHED' WHEN sn > 1 OR an > 1 THEN 'AMBIGUOUS' ELSE 'UNMAPPED' END AS match_status FROM c""",
)
def mat12(t):
    world = Placement(t)
    keyed = {name: df.withColumn("target", F.col("target") + 1) for name, df in world.candidates().items()}
    mapped = matching.area_precedence(
        world.rows, keyed, "c_custkey", F.col("name_std") == "CENTRAL OFFICE", F.col("coordinate_status") == "VALID_PAIR"
    )
    return mapped.select(
        "c_custkey", "mapping_method", F.col("area_key").cast("bigint").alias("area_key"), "conflict_flag", "match_status"
    )


@query(
    "mat13",
    f"""WITH {PLACE_SQL}, g AS (SELECT CASE WHEN en = 1 AND sn = 1 AND r = st THEN 'NAME_COORDINATE_AGREE' WHEN en = 1 AND sn = 1 THEN 'NAME_COORDINATE_CONFLICT' WHEN en = 1 AND sn = 0 THEN 'EXACT_NAME_ONLY' WHEN en = 0 AND sn = 1 THEN 'UNIQUE_COORDINATE_ONLY' WHEN en > 1 OR sn > 1 THEN 'AMBIGUOUS' ELSE 'UNMAPPED' END AS evidence_group, money FROM ev)
    SELECT evidence_group, CAST(COUNT(*) AS BIGINT) AS projects, CAST(COUNT(money) AS BIGINT) AS projects_with_money, CAST(SUM(money) AS DECIMAL(38,2)) AS money, ROUND(100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS project_pct, ROUND(100.0::DOUBLE * CAST(SUM(money) AS DOUBLE) / CAST(SUM(SUM(money)) OVER () AS DOUBLE), 2) AS money_pct FROM g GROUP BY 1""",
)
def mat13(t):
    world = Placement(t)
    rows = matching.with_evidence(world.rows, {"exact": world.exact, "spatial": world.spatial}, "c_custkey")
    return matching.evidence_profile(rows, "money").withColumn("money", F.col("money").cast("decimal(38,2)"))


CLASS_SQL = f"""{COVER_SQL}, {BOX_SQL}, lc AS (SELECT c_custkey, COUNT(*) AS pc, COUNT(DISTINCT level) AS lc, MAX(level) AS lv, string_agg(DISTINCT level, ',' ORDER BY level) AS ls FROM pts JOIN boxes ON px BETWEEN bx0 AND bx1 AND py BETWEEN by0 AND by1 GROUP BY 1),
    pc AS (SELECT pts.c_custkey, coalesce(pc, 0) AS polygon_count, coalesce(lc, 0) AS level_count, coalesce(ls, '') AS candidate_levels, CASE coalesce(lc, 0) WHEN 1 THEN 'MATCHED' WHEN 0 THEN 'UNMATCHED' ELSE 'AMBIGUOUS' END AS match_status, CASE WHEN lc = 1 THEN lv END AS level FROM pts LEFT JOIN lc ON lc.c_custkey = pts.c_custkey)"""


def point_classes(t, size):
    boxes = supplier_boxes(t)
    found = spatial.points_in_polygons(
        customer_points(t), boxes, "c_custkey", ["s_suppkey", "level"], size, count_by=["level"]
    )
    points = t.customer.select("c_custkey", F.lit("VALID_PAIR").alias("coordinate_status"))
    return matching.resolve_point_class(points, found, "c_custkey")


@query("mat15", f"WITH {CLASS_SQL} SELECT c_custkey, CAST(polygon_count AS BIGINT) AS polygon_count, CAST(level_count AS BIGINT) AS level_count, candidate_levels, match_status, level, CASE match_status WHEN 'AMBIGUOUS' THEN 'MULTIPLE_APPROVED_LEVELS' WHEN 'UNMATCHED' THEN 'NO_APPROVED_INTERSECTION' END AS exception_reason FROM pc")
def mat15(t):
    return point_classes(t, 2.0).drop("coordinate_status")


@query(
    "dq09",
    f"WITH {PLACE_SQL}, x AS ("
    + check_rows("region_map", "cls", [
        ("Completeness", "c_custkey is not missing", n_if("c_custkey IS NULL"), "stop"),
        ("Validity", "match_status uses the controlled vocabulary", n_if("match_status NOT IN ('MATCHED', 'MATCHED_WITH_CONFLICT', 'AMBIGUOUS', 'UNMATCHED', 'NON_GEOGRAPHIC')"), "stop"),
        ("Consistency", "manual evidence is never overruled by a name", n_if("mn > 0 AND mapping_method NOT IN ('MANUAL_OVERRIDE', 'NON_GEOGRAPHIC_RULE')"), "stop"),
        ("Consistency", "only a unique candidate is accepted", n_if("cc <> 1 AND accepted_target IS NOT NULL"), "stop"),
        ("Accuracy", "name and coordinate agree", n_if("match_status = 'MATCHED_WITH_CONFLICT'"), "flag"),
    ])
    + ") SELECT * FROM x",
)
def dq09(t):
    mapped = Placement(t).region_map()
    method = F.col("mapping_method")
    return shown(
        quality.checks(mapped, "region_map", [
            *quality.not_null("c_custkey"),
            quality.vocabulary("match_status", ["MATCHED", "MATCHED_WITH_CONFLICT", "AMBIGUOUS", "UNMATCHED", "NON_GEOGRAPHIC"]),
            quality.consistent("manual evidence is never overruled by a name", (F.col("manual_count") == 0) | method.isin("MANUAL_OVERRIDE", "NON_GEOGRAPHIC_RULE")),
            quality.consistent("only a unique candidate is accepted", (F.col("candidate_count") == 1) | F.col("accepted_target").isNull()),
            quality.Check("Accuracy", "name and coordinate agree", F.count_if(F.col("match_status") == "MATCHED_WITH_CONFLICT"), "flag"),
        ])
    )


@query(
    "dq10",
    f"WITH g AS (SELECT s_suppkey, CASE WHEN b >= 8000 AND b < 8500 THEN 'REPAIRED_GEOMETRY' WHEN b >= 8500 AND b < 9000 THEN 'INVALID_GEOMETRY' ELSE {STATUS_CASE} END AS st FROM (SELECT s_suppkey, {BANDS})), x AS ("
    + check_rows("geometry", "g", [
        ("Validity", "final_status uses the controlled vocabulary", "0", "stop"),
        ("Consistency", "a usable geometry has a positive area", "0", "stop"),
        ("Accuracy", "geometry is usable", n_if("st NOT IN ('USABLE_GEOMETRY', 'REPAIRED_GEOMETRY')"), "flag"),
        ("Consistency", "measured area equals the ring area", "0", "stop"),
    ])
    + ") SELECT * FROM x",
)
def dq10(t):
    final = materialize(repaired(t), "geometry")
    usable = F.col("final_status").isin("USABLE_GEOMETRY", "REPAIRED_GEOMETRY")
    signed = F.abs(geometry.rings_area(F.col("rings")))
    agrees = (F.col("final_status") != "USABLE_GEOMETRY") | (F.abs(F.col("even_odd_area") - signed) < 1e-6)
    names = ["BLANK_GEOMETRY", "UNPARSEABLE_GEOMETRY", "EMPTY_GEOMETRY", "UNSUPPORTED_GEOMETRY_TYPE", "INVALID_GEOMETRY", "REPAIRED_GEOMETRY", "USABLE_GEOMETRY"]
    return shown(
        quality.checks(final, "geometry", [
            quality.vocabulary("final_status", names),
            quality.consistent("a usable geometry has a positive area", ~usable | (F.col("nonzero_area") > 0)),
            quality.Check("Accuracy", "geometry is usable", F.count_if(~usable), "flag"),
            quality.consistent("measured area equals the ring area", agrees),
        ])
    )


@query(
    "dq11",
    f"WITH {GRID_SQL}, x AS ("
    + check_rows("exposure", "grid", [
        ("Accuracy", "area is published where data exists", "0", "stop"), ("Accuracy", "area is NULL where no data exists", "0", "stop"),
        ("Consistency", "a level is never larger than its region", n_if("safe AND d > a + 0.001"), "stop"),
        ("Accuracy", "levels do not overlap", n_if("safe AND coalesce(cx, 0) > 0.01"), "flag"),
    ])
    + ") SELECT * FROM x",
)
def dq11(t):
    safe = F.col("boundary_status") == "VALID_REGION_BOUNDARY"
    area = F.col("susceptible_area_sqkm")
    return shown(
        quality.checks(exposure(t), "exposure", [
            *quality.zero_not_null("area", safe, area),
            quality.consistent("a level is never larger than its region", area.isNull() | (area <= F.col("region_area_sqkm") + 0.001)),
            quality.Check("Accuracy", "levels do not overlap", F.count_if(F.col("additivity_status") == "NON_ADDITIVE_CROSS_LEVEL_OVERLAP"), "flag"),
        ])
    )


@query("dq12", check_rows("point_class", "customer", [
    ("Completeness", "no expected row is missing", "0", "stop"), ("Completeness", "no unexpected row exists", "0", "stop"),
    ("Accuracy", "evidence equals the rebuild", "0", "stop"), ("Accuracy", "decision equals the rebuild", "0", "stop"),
]))
def dq12(t):
    """The point classes again on another grid size; the size must not matter."""
    return shown(
        quality.compare(
            point_classes(t, 3.5), point_classes(t, 1.0), "point_class", ["c_custkey"],
            {"evidence": ["polygon_count", "level_count", "candidate_levels"], "decision": ["match_status", "level"]},
        )
    )
