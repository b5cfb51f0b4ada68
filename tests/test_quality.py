"""A healthy world passes the end gate; every mutation must stop it with a reason."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from verigrid.plans import quality
from verigrid.plans.quality import Check

T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
EVIDENCE = "results_table string, table_name string, validation_run_id string, run_ts timestamp, check_name string, status string, action string"
REQUIRED = "layer string, scope string, results_table string, anchor_table string, expected_tables array<string>"
HEALTHY = [
    ("silver_dq", "a", "v1", T1, "c1", "PASS", "stop"), ("silver_dq", "b", "v1", T1, "c2", "PASS", "stop"),
    ("gold_dq", "f", "v2", T1, "c3", "PASS", "stop"), ("gold_dq", "f", "v2", T1, "c4", "FLAG", "flag"),
]


def judge(spark, evidence, load=T0):
    required = spark.createDataFrame([("silver", "places", "silver_dq", "a", ["a", "b"]), ("gold", "fact", "gold_dq", "f", ["f"])], REQUIRED)
    log = spark.createDataFrame([("x", load, load)], "table_name string, started_at timestamp, completed_at timestamp")
    rows = quality.end_to_end(required, spark.createDataFrame(evidence, EVIDENCE), log)
    return {r.scope: r for r in rows.collect()}, {r.layer: r.gate_status for r in quality.summary(rows).collect()}


def test_healthy_world(spark):
    scopes, gate = judge(spark, HEALTHY)
    assert (scopes["places"].status, scopes["fact"].status) == ("PASS", "FLAG")
    assert gate == {"silver": "PASS", "gold": "FLAG", "ALL": "FLAG"}


@pytest.mark.parametrize(
    "mutate, reason",
    [
        (lambda e: e[:1] + [e[1][:5] + ("FAIL", "stop")] + e[2:], "1 blocking checks failed"),
        (lambda e: e[:1] + [e[1][:5] + ("ERROR", "flag")] + e[2:], "1 blocking checks failed"),
        (lambda e: e[:1] + [e[1][:5] + ("PASS", "maybe")] + e[2:], "1 blocking checks failed"),
        (lambda e: e[2:], "no saved evidence"),
        (lambda e: e[:1] + e[2:], "missing tables: b"),
        (lambda e: e[:1] + [e[1][:3] + (T2,) + e[1][4:]] + e[2:], "missing tables: b"),
    ],
)
def test_mutations_stop(spark, mutate, reason):
    scopes, gate = judge(spark, mutate(HEALTHY))
    assert scopes["places"].status == "FAIL" and reason in scopes["places"].details
    assert gate["silver"] == gate["ALL"] == "STOP"


def test_stale_evidence_stops(spark):
    scopes, gate = judge(spark, HEALTHY, load=T2)
    assert scopes["fact"].status == "FAIL" and "stale" in scopes["fact"].details and gate["ALL"] == "STOP"


def test_evidence_survives_the_gate(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/evidence"
    bad = Check("Validity", "no small ids", F.count_if(F.col("id") < 2))
    with pytest.raises(quality.GateError, match="no small ids"):
        quality.save_then_gate(quality.checks(spark.range(10), "t", [bad]), path)
    row = spark.read.parquet(path).first()
    assert (row.failed_rows, row.total_rows, row.percentage, row.status) == (2, 10, 20.0, "FAIL")


def test_compare_sees_every_kind_of_break(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0)], "k int, s string, m double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "y", 0.0), (4, "w", 4.0)], "k int, s string, m double")
    got = {r.check_name: r.failed_rows for r in quality.compare(a, b, "t", ["k"], {"text": ["s"], "money": ["m"]}).collect()}
    assert got == {"no expected row is missing": 1, "no unexpected row exists": 1, "text equals the rebuild": 0, "money equals the rebuild": 1}


def test_cross_layer_drift(spark):
    frame = lambda rows: spark.createDataFrame(rows, "m decimal(18,2), s string")
    from decimal import Decimal as D

    base = frame([(D("1.00"), "s1"), (None, "s1")])
    got = quality.cross_layer({"a": base, "b": base, "c": frame([(D("1.01"), "s1")]), "d": frame([(D("1.00"), "s2"), (None, "s1")])}, "m", "s")
    assert {(r.layer, r.check_name): r.status for r in got.collect()} == {
        ("b", "row count agrees"): "PASS", ("b", "money agrees"): "PASS", ("b", "one snapshot"): "PASS",
        ("c", "row count agrees"): "FAIL", ("c", "money agrees"): "FAIL", ("c", "one snapshot"): "PASS",
        ("d", "row count agrees"): "PASS", ("d", "money agrees"): "PASS", ("d", "one snapshot"): "FAIL",
    }


def test_marks_see_lost_pairs_and_changed_cells(spark):
    from verigrid.operators import resolve

    rows = [(i % 50, f"v{i}", None if i % 7 else "x") for i in range(400)] + [(None, "n", None)]
    schema = "k int, v string, w string"
    mark = lambda rs: tuple(quality.table_mark(spark.createDataFrame(rs, schema)).first())
    assert mark(rows) == mark(rows[::-1]) and mark(rows) != mark(rows + rows[:1] * 2)
    assert mark([(1, "ab", "c")]) != mark([(1, "a", "bc")]) and mark([(1, None, "-")]) != mark([(1, "-", None)])
    changed = [(k, v, "y" if v == "v3" else w) for k, v, w in rows] + [(9, "v9", None)] * 2 + [(77, "new", None)]
    found = resolve.differing_keys(spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema), ["k"], ["v", "w"], buckets=16)
    assert sorted(map(tuple, found.collect())) == [(3, 8, 8), (9, 8, 10), (77, 0, 1)]
    assert resolve.differing_keys(spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema), ["k"], ["v", "w"]).count() == 0


def test_mart_rebuilds_find_planted_faults(spark):
    from verigrid.queries import quality as suites
    from verigrid.queries import rebuild
    from verigrid.queries.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    good = suites.published_marts(t)
    first = {mart: good[mart].orderBy(*rebuild.KEYS[mart]).first() for mart in ("equity_mart", "monitoring_mart", "point_mart")}
    area, order = first["equity_mart"]["member_key"], first["point_mart"]["project_key"]
    here = F.col("project_key") == order
    bad = good | {
        # a status told otherwise, a project that is missing and one that no order holds, a value turned into NULL
        "equity_mart": good["equity_mart"].withColumn(
            "coverage", F.when(F.col("member_key") == area, "OTHER").otherwise(F.col("coverage"))
        ),
        "monitoring_mart": good["monitoring_mart"].withColumn("project_key", F.when(here, -1).otherwise(F.col("project_key"))),
        "point_mart": good["point_mart"].withColumn("hierarchy_status", F.when(~here, F.col("hierarchy_status"))),
    }
    names = list(rebuild.REBUILDS)
    results = suites.mart_checks(t, bad)
    found = set()
    for mart in first:
        for row in results[names.index(mart)].collect():
            if row["status"] != "PASS":
                found.add((mart, row["check_name"], row["failed_rows"]))
    assert found == {
        ("equity_mart", "status equals the rebuild", 1),
        ("monitoring_mart", "no expected row is missing", 1),
        ("monitoring_mart", "no unexpected row exists", 1),
        ("point_mart", "status equals the rebuild", 1),
    }


def test_buckets_grow_with_the_rows(spark):
    """A differing key brings few other rows along, however large the table is."""
    from verigrid.operators import resolve

    rows = spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("k") == 5, 99).otherwise(F.col("v")))
    found = resolve.differing_keys(rows, changed, ["k"], ["v"], buckets=1)
    assert [tuple(r) for r in found.collect()] == [(5, 1, 1)]
    assert "cast(312 as bigint)" in found._jdf.queryExecution().analyzed().toString()  # 40,000 rows in buckets of 128


def test_marks_are_sums_of_hashes(spark):
    import hashlib

    from verigrid.operators import resolve

    values = ["a", "a", "", None, "x" * 50]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    digests = [hashlib.md5(("-" if v is None else f"{len(v)}:{v}").encode()).hexdigest() for v in values]
    row = df.agg(*resolve.multiset_mark([F.col("v")])).first()
    want = (5, sum(int(d[:15], 16) for d in digests), sum(int(d[15:30], 16) for d in digests))
    assert tuple(int(x) for x in row) == want
    assert tuple(int(x) for x in resolve.multiset_marks(df, [], ["v"]).first()) == want


def test_statuses_are_grouped_without_sorting_texts(spark):
    from verigrid.operators import mapping

    rows = [
        (1, "A", "a", "g"), (1, "A", "a", "g"), (1, None, None, None), (2, "A", "a", "g"), (2, "B", "a", "g"), (3, "A", "a", None),
        (4, " ", "a", "g"), (None, "A", "a", "g"), (5, "A", "a", "g"), (5, "A", "b", "g"), (6, "C", None, None),
    ]
    df = spark.createDataFrame(rows, "k long, raw string, s string, grp string")
    out = mapping.publish_status(df, ["k"], F.col("raw"), {"s": F.col("s"), "grp": F.col("grp")})
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: (r["s"], r["grp"], r["status_mapping_state"]) for r in out.collect()}
    none = (None, None, "UNMAPPED")
    assert got == {1: ("a", "g", "MAPPED"), None: ("a", "g", "MAPPED"), **{k: none for k in (2, 3, 4, 5, 6)}}
