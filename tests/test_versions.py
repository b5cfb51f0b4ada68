"""Versions by day, the project fact's keys, and its gates."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from verigrid.operators.versions import overlapping_versions, valid_version
from verigrid.plans import model

START = date(2000, 1, 1)
VALID = ("since", "until")


def day(n):
    return None if n is None else START + timedelta(days=n)


@pytest.fixture(scope="module")
def history(spark):
    spans = [("a", i, None if i == 0 else 40 * i, None if i == 59 else 40 * (i + 1)) for i in range(60)]
    spans += [("b", 100, None, None), ("c", 101, 500, 900), ("c", 102, 1500, 1500), ("c", 103, 1200, None), (None, 104, None, None)]
    rows = [(code, key, day(since), day(until)) for code, key, since, until in spans]
    return rows, spark.createDataFrame(rows, "code string, member long, since date, until date")


def test_version_of_a_day_equals_brute_force(spark, history):
    spans, members = history
    # crowded code, codes without a version, a code and a day that are missing, and days right on the borders
    asked = [(i, "a" if i % 3 else "c", day(i * 7 - 900)) for i in range(900)]
    asked += [(1000 + i, "c", day(n)) for i, n in enumerate((499, 500, 899, 900, 1199, 1200, 1500))]
    asked += [(2000, "b", None), (2001, None, day(3)), (2002, "zz", day(3)), (2003, "b", date(1, 1, 1)), (2004, "b", date(9999, 1, 1))]
    want = {}
    for i, code, on in asked:
        hits = [
            key for c, key, since, until in spans
            if c is not None and c == code and on and (since is None or since <= on) and (until is None or on < until)
        ]
        assert len(hits) < 2
        want[i] = hits[0] if hits else None
    rows = spark.createDataFrame(asked, "id long, code string, on date")
    for width in (1, 31, 366, 10**6):
        got = valid_version(rows, members, {"code": "code"}, "on", VALID, {"member": "found"}, width)
        assert got.columns == ["id", "code", "on", "found"]
        pairs = got.select("id", "found").collect()
        assert len(pairs) == len(asked) and dict(map(tuple, pairs)) == want


def test_no_versions_and_no_rows(spark, history):
    _, members = history
    rows = spark.createDataFrame([(1, "a", day(5))], "id long, code string, on date")
    take = {"member": "found"}
    assert valid_version(rows, members.limit(0), {"code": "code"}, "on", VALID, take).collect()[0]["found"] is None
    assert valid_version(rows.limit(0), members, {"code": "code"}, "on", VALID, take).count() == 0
    open_only = members.filter("code = 'b'")
    assert valid_version(rows.withColumn("code", F.lit("b")), open_only, {"code": "code"}, "on", VALID, take).collect()[0]["found"] == 100


def test_overlaps_are_found(spark, history):
    _, members = history
    assert overlapping_versions(members, ["code"], VALID).count() == 0
    more = spark.createDataFrame([("c", 200, day(899), day(901))], members.schema)
    assert {r["member"] for r in overlapping_versions(members.union(more), ["code"], VALID).collect()} == {200}


def fact_of(spark, statuses, stop=True):
    projects = spark.createDataFrame(
        [(i, s, date(2001, 1, 1), None, 0.0, 5) for i, s in enumerate(statuses)],
        "project_key long, source_status string, start_date date, completion_date date, physical_progress_pct double, budget int",
    )
    members = spark.createDataFrame([("open",), ("done",)], "source_status string")
    statuses = model.dimension(members, "status_key", "STATUS", ["source_status"], {})
    rule = model.KeyRule(statuses, "status_key", {"source_status": "source_status"}, stop=stop)
    snapshot = spark.sql("SELECT DATE '2004-06-01' AS snapshot_date")
    return projects, model.snapshot_fact(projects, {"status_key": rule}, snapshot, "TEST", ["r1"])


def test_unmapped_status_stops_and_missing_status_is_key_0(spark):
    _, fact = fact_of(spark, ["open", None, "done"])
    rows = {r["contract_id"]: r for r in fact.collect()}
    assert rows[1]["status_key"] == 0 and rows[0]["status_key"] not in (0, rows[2]["status_key"])
    assert rows[0]["long_running_flag"] is True and rows[0]["source_snapshot_id"] == "TEST-20040601"
    assert len({r["project_snapshot_key"] for r in rows.values()}) == 3 and len({r["run_id"] for r in rows.values()}) == 1
    _, fact = fact_of(spark, ["open", "never seen"])
    with pytest.raises(Exception, match="STOP: status_key has no active member for never seen"):
        fact.collect()
    _, fact = fact_of(spark, ["open", "never seen"], stop=False)
    assert [r["status_key"] for r in fact.orderBy("contract_id").collect()][1] == 0


def test_fact_checks_see_repeats_and_missing_keys(spark):
    projects, fact = fact_of(spark, ["open", None, "done"])
    check = lambda made: model.fact_checks(made, projects, ["status_key"], "budget", "project_snapshot_key").first()["is_reconciled"]
    assert check(fact)
    repeated = fact.filter("contract_id < 2").union(fact.filter("contract_id = 0"))
    assert not check(repeated)
    assert not check(fact.withColumn("status_key", F.expr("nullif(status_key, 0)")))
    assert not check(fact.withColumn("budget", F.col("budget") + 1))


def test_boundary_rows_and_losses(spark):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    flat = [[[0.0, 0.0], [2.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]
    rows = [("a", "v1", square), ("a", "v2", flat), ("b", "v1", square), ("b", "v1", flat), ("a", None, None), ("zz", "v1", square)]
    shapes = spark.createDataFrame(rows, "code string, boundary_version string, rings array<array<array<double>>>")
    members = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "key long, code string")
    made = model.boundary_dimension(members, shapes, "key")
    got = {(r["code"], r["boundary_version"]): r for r in made.collect()}
    assert set(got) == {("a", "v1"), ("a", "v2"), ("a", None), ("b", "v1")}
    good, line, none, two = got["a", "v1"], got["a", "v2"], got["a", None], got["b", "v1"]
    assert good["geometry_valid_flag"] and (good["centroid_longitude"], good["centroid_latitude"]) == (1.0, 1.0) and good["rings"] == square
    assert line["geometry_valid_flag"] is False and line["publication_status"] == "PUBLISHED" and line["centroid_longitude"] is None
    assert none["geometry_valid_flag"] is False and none["feature_count"] == 1
    assert two["publication_status"] == "SKIPPED_AMBIGUOUS" and two["boundary_key"] is None and two["rings"] is None
    assert len({good["boundary_key"], line["boundary_key"], none["boundary_key"]}) == 3
    assert model.boundary_losses(made, shapes).first().asDict() == {"published": 3, "skipped_ambiguous": 2, "shapes": 6, "skipped_no_member": 1}
    empty = model.boundary_dimension(members, shapes.limit(0), "key")
    assert empty.count() == 0 and model.boundary_losses(empty, shapes.limit(0)).first()["skipped_no_member"] == 0


def test_published_views_are_exactly_the_given_ones(spark):
    from verigrid.sinks import publish

    text = "SELECT id, id * 2 AS twice FROM range(3)"
    notes = {"id": "The number's id, a \\ sign.", "twice": "Twice."}
    assert publish.publish_catalog_views(spark, "vt_", {"vt_a": (text, notes), "vt_b": (text, notes)}) == ["vt_a", "vt_b"]
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE vt_a").collect()}
    assert comments == notes
    with pytest.raises(ValueError, match="nobody knows: \\['vt_b'\\]"):
        publish.publish_catalog_views(spark, "vt_", {"vt_a": (text, notes)})
    with pytest.raises(ValueError, match="comments for"):
        publish.publish_catalog_views(spark, "vt_", {"vt_a": (text, {"id": "x"}), "vt_b": (text, notes)})
    assert publish.publish_catalog_views(spark, "vt_", {"vt_a": (text, notes)}, ["vt_b", "vt_never"]) == ["vt_a"]
    assert [r["viewName"] for r in spark.sql("SHOW VIEWS LIKE 'vt_*'").collect()] == ["vt_a"]
    publish.publish_catalog_views(spark, "vt_", {}, ["vt_a"])
