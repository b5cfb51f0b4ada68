"""Spatial operators against brute force on small random polygons."""

import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from verigrid.operators import matching, spatial
from verigrid.queries import geo  # noqa: F401  (registers the queries)
from verigrid.queries.registry import QUERIES, SQL

SCHEMA = "pid int, rings array<array<array<double>>>"


def star(rng, cx, cy, n=7):
    points = []
    for i in range(n):
        r = rng.uniform(0.5, 3)
        a = 2 * math.pi * i / n
        points.append([cx + r * math.cos(a), cy + r * math.sin(a)])
    return [points + [points[0]]]


def polygons(seed=3, count=12):
    rng = random.Random(seed)
    made = [(i, star(rng, rng.uniform(-4, 8), rng.uniform(-4, 8), rng.randint(3, 9))) for i in range(count)]
    box = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 1.0], [1.0, 3.0], [3.0, 3.0], [3.0, 1.0], [1.0, 1.0]]
    return made + [(100, [box, hole])]


def covers(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


def test_point_in_polygon_any_cell_size(spark):
    rng = random.Random(5)
    shapes = polygons()
    points = [(i, rng.uniform(-6, 10), rng.uniform(-6, 10)) for i in range(300)]
    # corners, edges, hole border, cell borders, and a crowd in one cell
    special = [(0, 0), (4, 2), (2, 4), (1, 2), (2, 1), (2, 2), (4, 4), (3, 3), (2, 0)]
    points += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate(special)]
    points += [(2000 + i, 0.5 + i * 1e-4, 0.5) for i in range(400)]
    # at, just below and just above borders that are no binary fractions
    borders = [k * size for size in (0.1, 0.3, 0.7) for k in range(1, 6)]
    near = [y for x in borders for y in (x, math.nextafter(x, -9), math.nextafter(x, 9))]
    points += [(3000 + i, x, 0.5) for i, x in enumerate(near)] + [(4000 + i, 0.5, x) for i, x in enumerate(near)]
    want = {(i, p) for i, x, y in points for p, rings in shapes if covers(rings, x, y)}
    pts = spark.createDataFrame(points, "id long, x double, y double")
    df = spark.createDataFrame(shapes, SCHEMA)
    for size in (0.1, 0.3, 0.5, 0.7, 2.0, 50.0):
        got = {tuple(r) for r in spatial.points_in_polygons(pts, df, "id", ["pid"], size).collect()}
        assert got == want, size


def grid_area(tests, step=0.02, low=-8.0, high=12.0):
    axis = np.arange(low + step / 2, high, step)
    xs, ys = np.meshgrid(axis, axis)
    return [t(xs, ys).sum() * step * step for t in tests]


def mask(rings, xs, ys):
    inside = np.zeros_like(xs, dtype=bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if y1 != y2:
                inside ^= ((y1 <= ys) != (y2 <= ys)) & (xs < x1 + (ys - y1) * (x2 - x1) / (y2 - y1))
    return inside


def test_overlay_areas(spark):
    shapes = [(i, "low" if i % 2 else "high", r) for i, r in polygons()]
    shapes += [(500 + i, "low", shapes[1][2]) for i in range(5)]  # copies of one polygon
    region = [[[-2.0, -3.0], [7.0, -1.0], [6.0, 7.0], [-3.0, 5.0], [-2.0, -3.0]]]
    clip = lambda xs, ys: mask(region, xs, ys)
    union = lambda group: lambda xs, ys: clip(xs, ys) & np.any([mask(r, xs, ys) for _, g, r in shapes if group in (None, g)], axis=0)
    want_low, want_high, want_all, want_region = grid_area([union("low"), union("high"), union(None), clip])
    fragments = sum(grid_area([lambda xs, ys, r=r: clip(xs, ys) & mask(r, xs, ys) for _, g, r in shapes if g == "low"]))
    df = spark.createDataFrame(shapes, "polygon_id int, level string, rings array<array<array<double>>>")
    reg = spark.createDataFrame([("R", region)], "region string, rings array<array<array<double>>>")
    results = []
    for size, limit in ((3.0, 2000), (20.0, 2000), (20.0, 5)):
        rows = {r["level"]: r for r in spatial.overlay_area(df, reg, size, refine_over=limit).collect()}
        low, high = rows["low"], rows["high"]
        for got, want in (
            (low.dissolved_area, want_low), (high.dissolved_area, want_high), (low.union_area, want_all),
            (low.region_area, want_region), (low.fragment_area, fragments),
        ):
            assert abs(got - want) < 0.15, (size, limit, got, want)
        results.append((low.dissolved_area, high.dissolved_area, low.union_area, low.fragment_area, low.source_polygon_count))
    for other in results[1:]:
        assert np.allclose(results[0], other, rtol=1e-9)


def test_measure_finds_crossings(spark):
    bow_tie = [[[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 4.0], [0.0, 0.0]]]
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    df = spark.createDataFrame([("bow", bow_tie), ("square", square)], "k string, rings array<array<array<double>>>")
    rows = {r["k"]: r for r in spatial.measure_polygons(df, "k", 1.5).collect()}
    assert not rows["bow"].turns_once and abs(rows["bow"].even_odd_area - 10 / 3) < 1e-9
    assert rows["square"].turns_once and abs(rows["square"].nonzero_area - 4) < 1e-9


def test_parse_methods_and_statuses(spark):
    texts = [
        None, '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}',
        '{"type":"Polygon","coordinates":[[["0","0"],["2","0"],["2","2"],["0","2"],["0","0"]]]}',
        '{"rings":[[[0,0],[0,2],[2,2],[2,0],[0,0]]]}', '{"type":"LineString","coordinates":[[0,0],[1,1]]}', "{oops",
        '{"type":"Polygon","coordinates":[[[0,0],[2,0],[4,0],[0,0]]]}',
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, j string")
    rows = sorted(spatial.parse_polygons(df, "j").collect(), key=lambda r: r.i)
    assert [(r.geometry_parse_method, r.geometry_status) for r in rows] == [
        ("NOT_PARSED", "BLANK_GEOMETRY"), ("GEOJSON_AS_PUBLISHED", "USABLE_GEOMETRY"),
        ("GEOJSON_QUOTED_NUMBERS_NORMALIZED", "USABLE_GEOMETRY"), ("ESRI_JSON_CONVERTED", "USABLE_GEOMETRY"),
        ("PARSE_FAILED", "UNSUPPORTED_GEOMETRY_TYPE"), ("PARSE_FAILED", "UNPARSEABLE_GEOMETRY"),
        ("GEOJSON_AS_PUBLISHED", "INVALID_GEOMETRY"),
    ]


def test_esri_metres_land_in_degrees(spark):
    a = 6378137.0
    place = lambda lon, lat: [math.radians(lon) * a, math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) * a]
    ring = [place(*p) for p in ((120.0, 14.0), (120.0, 15.0), (121.0, 15.0), (121.0, 14.0), (120.0, 14.0))]
    texts = [f'{{"rings":[{ring}],"spatialReference":{{"wkid":{w}}}}}' for w in (102100, 3857)] + ['{"rings":[[[120,14],[120,15],[121,15],[121,14],[120,14]]],"spatialReference":{"wkid":4326}}']
    rows = spatial.bounding_box(spatial.parse_polygons(spark.createDataFrame([(t,) for t in texts], "j string"), "j")).collect()
    for r in rows:
        assert r.geometry_parse_method == "ESRI_JSON_CONVERTED" and np.allclose([r.xmin, r.ymin, r.xmax, r.ymax], [120, 14, 121, 15])


def test_wkb_round_trip(spark):
    df = spark.createDataFrame(polygons(), SCHEMA)
    back = df.withColumn("back", spatial.from_wkb(spatial.to_wkb(F.col("rings"))))
    assert back.filter(F.col("back") != F.col("rings")).count() == 0


def circle(n, cx=0.3, cy=0.2, r=7.3):
    ring = [[cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)] for i in range(n)]
    return [ring + [ring[0]]]


def test_rows_below_do_not_grow_with_vertices(spark):
    held = {}
    for n in (2_000, 20_000, 200_000):
        df = spark.createDataFrame([(1, circle(n))], SCHEMA)
        pieces = spatial.cut(spatial.edges(df, ["pid"]), ["pid"], 1.0).filter("is_below")
        held[n] = pieces.agg(F.count("*").alias("all")).first()["all"], pieces.groupBy("ix", "iy").count().agg(F.max("count")).first()[0]
    assert max(a for a, _ in held.values()) <= 1.05 * held[2_000][0] and max(m for _, m in held.values()) <= 4, held


def test_steps_cancel_at_every_cell_size(spark):
    """Points high above a jagged chain, and inside and above a ring that folds back on itself."""
    rng = random.Random(11)
    jagged = [[i / 10, rng.choice([0.0, 0.05, 0.3])] for i in range(101)]
    lid = [[10.0, 9.0], [5.0, 6.5], [0.0, 9.0]]
    folded = [[0.0, 0.0], [6.0, 0.5], [3.0, 1.0], [8.0, 1.5], [8.0, 7.0], [2.0, 7.5], [5.0, 6.0], [0.0, 6.0], [0.0, 0.0]]
    shapes = [(1, [jagged + lid + [jagged[0]]]), (2, [folded])]
    points = [(i, rng.uniform(-1, 11), rng.uniform(-1, 10)) for i in range(400)]
    want = {(i, p) for i, x, y in points for p, rings in shapes if covers(rings, x, y)}
    pts, df = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(shapes, SCHEMA)
    for size in (0.25, 1.0, 3.7):
        assert {tuple(r) for r in spatial.points_in_polygons(pts, df, "id", ["pid"], size).collect()} == want, size


def square(x, y, a=1.0):
    return [[[x, y], [x + a, y], [x + a, y + a], [x, y + a], [x, y]]]


def test_equal_shapes_and_shared_borders_do_not_crowd_a_cell(spark):
    schema = "g string, pid int, rings array<array<array<double>>>"
    tilted = [[[0.0, 0.0], [3.0, 1.0], [2.0, 4.0], [-1.0, 3.0], [0.0, 0.0]]]
    for n in (1_000, 4_000):
        df = spark.createDataFrame([("a", i, tilted) for i in range(n)], schema)
        for once in (False, True):
            assert abs(spatial.union_area(df, "g", "pid", 50.0, limit=20, turns_once=once).first()["union_area"] - 10) < 1e-9
    # a full board of squares is one square, whatever its fields: four lines of which two are left
    board = spark.createDataFrame([("b", 40 * i + j, square(float(i), float(j))) for i in range(40) for j in range(40)], schema)
    lines = spatial.merged_lines(spatial.edges(board, ["g", "pid"]).drop("pid"), ["g"])
    assert sorted((r.x1, r.y1, r.x2, r.y2, r.w) for r in lines.collect()) == [(0, 0, 40, 0, 1), (0, 40, 40, 40, -1)]
    assert spatial.union_area(board, "g", "pid", 64.0, turns_once=True).first()["union_area"] == 1600


def test_refinement_goes_as_far_as_it_helps(spark):
    """A crowd of small squares in one corner of a large cell needs more than three rounds."""
    squares = [("c", i, square(i % 20 / 4096, i // 20 / 4096, 1 / 8192)) for i in range(400)]
    df = spark.createDataFrame(squares, "g string, pid int, rings array<array<array<double>>>")
    area = spatial.union_area(df, "g", "pid", 4096.0, limit=30).first()["union_area"]
    assert abs(area - 400 / 8192**2) < 1e-15


def test_union_counts_parity_where_polygons_do_not_turn_once(spark):
    twice = [square(0.0, 0.0)[0], square(0.0, 0.0)[0]]
    df = spark.createDataFrame([("d", 1, twice), ("d", 2, square(0.5, 0.0))], "g string, pid int, rings array<array<array<double>>>")
    assert abs(spatial.union_area(df, "g", "pid", 3.0).first()["union_area"] - 1) < 1e-12


def test_pairs_of_one_cell_row_are_not_shuffled(spark):
    rng = random.Random(8)
    shapes = polygons()
    points = [(i, rng.uniform(-6, 10), rng.uniform(-6, 10)) for i in range(200)]
    want = {(i, p) for i, x, y in points for p, rings in shapes if covers(rings, x, y)}
    pts, df = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(shapes, SCHEMA)
    found = spatial.points_in_polygons(pts, df, "id", ["pid"], 2.0)
    assert {tuple(r) for r in found.collect()} == want
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "hashpartitioning(id" not in final
    # polygons with more parts in a cell are summed up part by part
    for most in (0, 1, 3):
        got = {tuple(r) for r in spatial.points_in_polygons(pts, df, "id", ["pid"], 2.0, most_parts=most).collect()}
        assert got == want, most


def test_ids_that_points_share_are_summed_up(spark):
    box = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]
    points = [(1, 1.5, 1.5), (1, 9.0, 9.0), (2, 2.5, 2.5), (2, 2.5, 2.5), (2, 3.5, 0.5), (None, 1.5, 1.5), (3, None, 1.0)]
    pts = spark.createDataFrame(points, "id long, x double, y double")
    df = spark.createDataFrame([(7, box), (8, box), (8, box)], SCHEMA)
    got = {tuple(r) for r in spatial.points_in_polygons(pts, df, "id", ["pid"], 1.0).collect()}
    assert got == {(1, 7), (2, 7), (None, 7)}


def test_small_cells_are_measured_by_as_many_tasks_as_there_are_cores(spark):
    box = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]
    df = spark.createDataFrame([(i, box) for i in range(500)], SCHEMA)
    pieces = spatial._own_cells(spatial.edges(df, ["pid"]), F.col("pid"), F.col("pid"), ["pid"], 1.0, 2000)
    areas = spatial._areas(pieces)
    plan = areas._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan and "REPARTITION_BY_NUM" in plan
    measured = spatial.measure_polygons(df, "pid", 1.0).collect()
    assert len(measured) == 500 and {r["even_odd_area"] for r in measured} == {16.0}


def stages_seen(monkeypatch):
    """The stages that spatial writes: label, plan before it runs, number of rows."""
    seen, write = {}, spatial.materialize

    def watched(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        written = write(df, label)
        seen[label] = (plan, written.count())
        return written

    monkeypatch.setattr(spatial, "materialize", watched)
    return seen


def test_only_hot_cells_are_broadcast(spark, monkeypatch):
    seen = stages_seen(monkeypatch)
    pts = spark.range(200).selectExpr("id", "id % 20 / 2.0 AS x", "id % 7 / 1.0 AS y")
    df = spark.createDataFrame(polygons(), SCHEMA)
    found = spatial.points_in_polygons(pts, df, "id", ["pid"], 1.0)
    assert {"points", "shapes", "edges", "cut", "pieces"} <= set(seen)
    assert not [label for label, (plan, _) in seen.items() if "BroadcastExchange" in plan]
    # for points and for parts in three joins
    assert found._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == 6


def test_equal_shapes_are_cut_once(spark, monkeypatch):
    made = polygons(count=3)
    pts = spark.createDataFrame([(i, i % 9 / 1.0, i // 9 / 1.0) for i in range(81)], "id long, x double, y double")
    rows = {}
    for copies in (1, 50):
        shapes = [(1000 * i + pid, rings) for i in range(copies) for pid, rings in made]
        monkeypatch.undo()
        seen = stages_seen(monkeypatch)
        monkeypatch.setattr(spatial, "MEMBERS", 7)
        got = {tuple(r) for r in spatial.points_in_polygons(pts, spark.createDataFrame(shapes, SCHEMA), "id", ["pid"], 2.0).collect()}
        assert got == {(i, pid) for i, x, y in pts.collect() for pid, rings in shapes if covers(rings, x, y)}
        rows[copies] = seen["pieces"][1]
    assert rows[1] == rows[50]


def test_covering_polygons_are_counted_by_class_without_pairs(spark):
    rng = random.Random(4)
    made = polygons()
    # copies of whole shapes, one of them twice under the same keys, and boxes that differ but cover whole cells
    boxes = [[[[-9.0 - i, -9.0], [12.0, -9.0], [12.0, 12.0 + i], [-9.0 - i, 12.0 + i], [-9.0 - i, -9.0]]] for i in range(20)]
    shapes = [(pid, "abc"[pid % 3], rings) for pid, rings in made] + [(200 + i, "d", made[0][1]) for i in range(30)]
    shapes += [(300 + i, "e", box) for i, box in enumerate(boxes)] + [(400, None, boxes[0]), (500, "f", boxes[0]), (500, "f", boxes[0])]
    points = [(i, rng.uniform(-6, 10), rng.uniform(-6, 10)) for i in range(150)] + [(900, 1.0, 1.0), (900, 1.0, 1.0), (None, 2.0, 2.0), (901, None, 2.0)]
    pts = spark.createDataFrame(points, "id long, x double, y double")
    df = spark.createDataFrame(shapes, "pid int, level string, rings array<array<array<double>>>")
    for size, most in ((0.7, 256), (2.0, 256), (2.0, 1), (50.0, 256)):
        pairs = spatial.points_in_polygons(pts, df, "id", ["pid", "level"], size)
        want = {tuple(r) for r in pairs.groupBy("id", "level").count().collect()}
        counted = spatial.points_in_polygons(pts, df, "id", ["pid", "level"], size, most_parts=most, count_by=["level"])
        got = {tuple(r) for r in counted.groupBy("id", "level").agg(F.sum("polygons")).collect()}
        assert got == want and ("e" in {level for _, level, _ in got}), (size, most)


def test_a_cell_that_polygons_cover_is_one_row_of_each_class(spark):
    boxes = [(i, "xy"[i % 2], [[[-9.0 - i, -9.0], [12.0, -9.0], [12.0, 12.0 + i], [-9.0 - i, 12.0 + i], [-9.0 - i, -9.0]]]) for i in range(60)]
    pts = spark.createDataFrame([(i, i % 4 + 0.5, 0.5) for i in range(40)], "id long, x double, y double")
    df = spark.createDataFrame(boxes, "pid int, level string, rings array<array<array<double>>>")
    rows = spatial.points_in_polygons(pts, df, "id", ["pid", "level"], 2.0, count_by=["level"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted((i, level, 30) for i in range(40) for level in "xy")


def test_point_classes_take_a_few_rows_of_a_point_however_many_polygons_hold_it(spark, monkeypatch, tmp_path):
    customers = [(i, i % 3, 50.0 * i) for i in range(90)]
    suppliers = [(i, i % 3, 25.0 * (i % 300)) for i in range(900)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    seen, resolve = [], matching.resolve_point_class

    def watched(points, candidates, key):
        seen.append(candidates.groupBy(key).count().agg(F.max("count")).first()[0])
        return resolve(points, candidates, key)

    monkeypatch.setattr(matching, "resolve_point_class", watched)
    duck = duckdb.connect()
    for table in ("customer", "supplier"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name in ("mat15", "dq12"):
        df = QUERIES[name](spark, str(tmp_path))
        told = duck.execute(SQL[name])
        columns = [c[0] for c in told.description]
        rows = lambda found: sorted((tuple(r) for r in found), key=repr)
        assert rows(df.select(*columns).collect()) == rows(told.fetchall())
        if name == "mat15":
            assert df.agg(F.max("polygon_count")).first()[0] > 100
    # a level's row for what covers the cell, and one for each way its borders cross the cell
    assert len(seen) == 3 and max(seen) <= 30, seen
