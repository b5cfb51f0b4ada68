import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from verigrid.plans import quality
from verigrid.sinks import publish as sink
from verigrid.sinks import upsert
from verigrid.sources import contracts, dump_rows, loader, snapshot

CONTRACT = contracts.SourceContract("s", "t", {"id": ["ID"], "value": ["value", "amount"]}, expected_rows=2)


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def written(text, name="a.csv"):
    path = Path(folder()) / name
    path.write_bytes(text.encode())
    return str(path)


def test_header_rules(spark):
    assert contracts.safe_names(["id", "a b", "c(d)"]) == (["id", "a_b", "c_d_"], {"id": "id", "a b": "a_b", "c(d)": "c_d_"})
    for header in (["id", "ID"], ["_source_path"], ["a b", "a_b"], [" "]):
        with pytest.raises(contracts.ContractError):
            contracts.safe_names(header)
    contracts.require_header(CONTRACT, ["id", "Amount"])
    with pytest.raises(contracts.ContractError, match="value"):
        contracts.require_header(CONTRACT, ["id"])
    drift = contracts.header_drift(spark, ["a", "b"], ["b", "c"])
    assert {tuple(r) for r in drift.collect()} == {("a", "REMOVED"), ("c", "ADDED")}


def test_line_scan_is_strict(spark):
    good = written('id,value\r\n1,"a,""q"""\r\n2,\r\n')
    rows = snapshot.scan_lines(spark, good, ["id", "value"], "\r\n").collect()
    assert sorted(map(tuple, rows)) == [("1", 'a,"q"'), ("2", "")]
    for bad in ("id,value\n1,a,b\n", "id,value\n1\n"):
        with pytest.raises(Exception):
            snapshot.scan_lines(spark, written(bad), ["id", "value"]).collect()


@pytest.mark.parametrize("line", ['1,"x', '1,"a"b', '1,"a"b"c"', '"1"2,a', '1,"a" ', '1,a\rb', '1,"a""', '1,2,""b"'])
def test_line_scan_stops_at_bad_quoting(spark, line):
    with pytest.raises(Exception, match="no well-formed record"):
        snapshot.scan_lines(spark, written(f"id,value\n{line}\n"), ["id", "value"]).collect()


def test_line_scan_reads_what_is_well_formed(spark):
    text = '\ufeff"id",value\r\n1,a"b\r\n"2",""\r\n3,"""x"", y"\r\n4,\r\n5," s "\r\n'
    rows = snapshot.scan_lines(spark, written(text), ["id", "value"]).collect()
    assert [tuple(r) for r in rows] == [("1", 'a"b'), ("2", ""), ("3", '"x", y'), ("4", ""), ("5", " s ")]
    long = '""'.join(["x" * 50] * 40_000)
    assert snapshot.scan_lines(spark, written(f'id,value\n1,"{long}"\n'), ["id", "value"]).first()["value"] == long.replace('""', '"')


def test_each_file_begins_with_the_header(spark):
    path = Path(written("id,value\n1,a\n", "a.csv")).parent
    (path / "b.csv").write_text("2,b\nid,value\n")
    with pytest.raises(Exception, match="not the header"):
        snapshot.scan_lines(spark, str(path), ["id", "value"]).collect()


def test_records_with_line_breaks_are_read_by_many_splits(spark):
    """Fields with line breaks, doubled quotes and commas, cut into splits of a few hundred bytes."""
    import csv
    import io
    import random

    rng = random.Random(8)
    fields = ["", "a", "b,c", 'say "hi"', "two\nlines", '"\n"', "\n\n\n", "x" * 90, "line\r\nend", "word\n" * 200]
    rows = [[str(i), rng.choice(fields), rng.choice(fields)] for i in range(600)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\r\n").writerows([["id", "a", "b"], *rows])
    path = Path(written(out.getvalue(), "a.csv")).parent
    (path / "b.csv").write_bytes(b"id,a,b\n7,x,\"only\none\"")
    contract = contracts.SourceContract("s", "t", {"id": ["id"]}, multi_line=True)
    want = sorted([tuple(r) for r in rows] + [("7", "x", "only\none")])
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "4096", "300"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            scan = snapshot.scan_csv(spark, str(path), ["id", "a", "b"], contract)
            assert sorted(map(tuple, scan.collect())) == want, size
            counts = snapshot.file_records(snapshot.contract_records(spark, str(path), contract), ["id", "a", "b"]).first()
            assert tuple(counts) == (603, 2, 0)
        assert snapshot.records(spark, str(path), multi_line=True).rdd.getNumPartitions() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_escaped_quotes_and_open_ends(spark):
    contract = contracts.SourceContract("s", "t", {"id": ["id"]}, multi_line=True, escape="\\")
    path = written('id,v\n1,"a \\"b\\"\nc"\n2,"\\\\"\n')
    rows = snapshot.scan_csv(spark, path, ["id", "v"], contract).collect()
    assert [tuple(r) for r in rows] == [("1", 'a "b"\nc'), ("2", "\\")]
    with pytest.raises(Exception, match="no well-formed record"):
        snapshot.scan_csv(spark, written('id,v\n1,"open\n2,b\n'), ["id", "v"], contract).collect()


@pytest.mark.parametrize(("text", "status"), [("id,value\n1,a\n2,b\n", "PASS"), ("id,value\n1,a\nid,value\n2,b\n", "FAIL")])
def test_header_occurs_once(spark, text, status):
    path = written(text)
    rows = snapshot.scan_lines(spark, path, ["id", "value"])
    results = snapshot.reconcile_rows(rows, rows.count(), snapshot.header_lines(spark, path, ["id", "value"]), "t")
    assert {r.check_name: r.status for r in results.collect()}["header occurs once per file"] == status


def test_csv_scan_is_strict(spark):
    rows = snapshot.scan_csv(spark, written("id,value\n1,a\n"), ["id", "value"], CONTRACT).collect()
    assert [tuple(r) for r in rows] == [("1", "a")]
    for bad in ("id,value\n1,a,b\n", "id,other\n1,a\n"):
        with pytest.raises(Exception):
            snapshot.scan_csv(spark, written(bad), ["id", "value"], CONTRACT).collect()


def test_load_decisions(spark):
    log = spark.createDataFrame(
        [("s", "1", "r1", "STARTED", 1, None, None, "A"), ("s", "2", "r2", "SUCCESS", 1, 2, 5, "A"), ("s", "3", "r3", "SUCCESS", 1, 2, 5, "B"), ("s", "4", "r4", "FAILED", 1, 2, 0, "A")],
        "source_name string, snapshot_id string, run_id string, status string, started_at int, completed_at int, rows_loaded long, mark string",
    )
    wanted = spark.createDataFrame([("s", str(i), "A") for i in range(1, 5)], "source_name string, snapshot_id string, mark string")
    got = {r.snapshot_id: r.decision for r in snapshot.load_decision(log, wanted, ["mark"]).collect()}
    assert got == {"1": "LOAD", "2": "SKIPPED_IDEMPOTENT", "3": "CONFLICT", "4": "LOAD"}


def events(spark, root):
    rows = loader.read_audit(spark, root).orderBy("started_at", F.col("completed_at").asc_nulls_first()).collect()
    return [(r.run_id, r.status, r.rows_loaded) for r in rows], [r.error_message for r in rows if r.status == "FAILED"]


def test_loader_events_and_claims(spark):
    root = folder()
    contract = contracts.SourceContract("s", "t", {"id": ["id"], "value": ["value"]}, multi_line=True)
    good, bad = written('id,value\n1,"a\nb"\n2,c\n'), written("id,value\n1,a\nid,value\n2,b\n")
    go = lambda path, run, **more: loader.load(spark, path, ["id", "value"], contract, root, run, "d1", **more)
    other = loader.Claim(spark, root, "s", "d1")
    other.take("r0")
    with pytest.raises(loader.SnapshotConflict, match="run r0 is loading"):
        go(good, "r1")
    assert sink.read_pointer(spark, root, "t") is None
    assert go(good, "r2", take_over="r0") == ("SUCCESS", 2) and other.holder() is None
    assert go(good, "r3") == ("SKIPPED_IDEMPOTENT", 2)
    with pytest.raises(loader.SnapshotConflict, match="loaded from other files by run r2"):
        go(bad, "r4")
    with pytest.raises(quality.GateError):
        loader.load(spark, bad, ["id", "value"], contract, root, "r5", "d2")
    assert loader.Claim(spark, root, "s", "d2").holder() is None
    assert sorted(r.value for r in sink.read_published(spark, root, "t").collect()) == ["a\nb", "c"]
    log, errors = events(spark, root)
    assert log == [("r1", "FAILED", None), ("r2", "STARTED", None), ("r2", "SUCCESS", 2), ("r3", "SKIPPED_IDEMPOTENT", 2), ("r4", "FAILED", None), ("r5", "STARTED", None), ("r5", "FAILED", None)]
    assert "header occurs once per file" in errors[2] and all(errors)


def test_skipped_load_needs_the_published_rows(spark):
    """Another snapshot was published since: the same snapshot is loaded again."""
    root = folder()
    contract = contracts.SourceContract("s", "t", {"id": ["id"]})
    one, two = written("id\n1\n"), written("id\n2\n3\n")
    assert loader.load(spark, one, ["id"], contract, root, "r1", "d1") == ("SUCCESS", 1)
    assert loader.load(spark, two, ["id"], contract, root, "r2", "d2") == ("SUCCESS", 2)
    assert loader.load(spark, one, ["id"], contract, root, "r3", "d1") == ("SUCCESS", 1)
    with pytest.raises(contracts.ContractError):
        loader.load(spark, one, ["other"], contract, root, "r4", "d3")
    assert [r.id for r in sink.read_published(spark, root, "t").collect()] == ["1"]


def test_dump_rows_add_up(spark):
    cells = [["Title"], ["name", "n"], ["A", "1"], ["", ""], ["odd", "x"], ["Note: a", ""], ["more notes", ""], ["B", "2"], ["odd", "y"]]
    rows = spark.createDataFrame([("f", "s", i, c + [""] * (2 - len(c))) for i, c in enumerate(cells)], "file string, sheet string, row_no int, cells array<string>")
    table = F.col("table_cells")
    got = dump_rows.classify_dump_rows(rows, 1, 2, table[1].rlike("^[0-9]+$"), F.lower(table[0]).startswith("note"))
    roles = [r.row_role for r in got.orderBy("row_no").collect()]
    assert roles == ["TITLE", "TITLE", "DATA", "BLANK", "ISSUE", "NOTE", "NOTE", "DATA", "ISSUE"]
    assert dump_rows.manifest(got).first().adds_up


def test_publish_moves_pointer_only_after_checks(spark):
    root = folder()
    frame = lambda n: spark.range(n).withColumnRenamed("id", "k")
    rule = lambda df: quality.checks(df, "t", [quality.Check("Completeness", "has rows", F.when(F.count(F.lit(1)) > 0, 0).otherwise(1))])
    assert sink.publish(frame(3), root, "t", "r1", rule)[0] == "PUBLISHED"
    assert sink.publish(frame(3), root, "t", "r1", rule)[0] == "SKIPPED_CURRENT"
    with pytest.raises(quality.GateError):
        sink.publish(frame(0), root, "t", "r2", rule)
    assert sink.read_published(spark, root, "t").count() == 3
    sink.publish(frame(5), root, "t", "r3", rule)
    assert sink.read_published(spark, root, "t").count() == 5


def test_failed_rerun_of_the_live_run_harms_nothing(spark):
    root = folder()
    rule = lambda df: quality.checks(df, "t", [quality.Check("Completeness", "few rows", F.when(F.count(F.lit(1)) < 9, 0).otherwise(1))])
    sink.publish(spark.range(5), root, "t", "r1", rule)
    pointer = sink.read_pointer(spark, root, "t")
    lost = sink.run_path(root, "t", "r1", pointer["attempt"])
    spark.range(4).write.mode("overwrite").parquet(lost)  # a row is missing: the rerun is not skipped
    with pytest.raises(quality.GateError):
        sink.publish(spark.range(99), root, "t", "r1", rule)
    assert sink.read_published(spark, root, "t").count() == 4
    assert sink.publish(spark.range(5), root, "t", "r1", rule)[0] == "PUBLISHED"
    assert sink.read_published(spark, root, "t").count() == 5


def test_snapshot_upsert_refuses_older(spark):
    schema = "k int, v string, cur boolean, day string"
    target = spark.createDataFrame([(1, "a", True, "2024-02"), (2, "b", True, "2024-02")], schema)
    newer = spark.createDataFrame([(2, "c", True, "2024-03"), (3, "d", True, "2024-03")], schema)
    rows = {r.k: (r.v, r.cur) for r in upsert.snapshot_upsert(target, newer, ["k"], "cur", "day").collect()}
    assert rows == {1: ("a", False), 2: ("c", True), 3: ("d", True)}
    with pytest.raises(Exception, match="older snapshot"):
        upsert.snapshot_upsert(target, newer.withColumn("day", F.lit("2024-01")), ["k"], "cur", "day").collect()


def test_views_need_comments(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        sink.publish_views({"v1": (df, {})})
    assert sink.publish_views({"v1": (df, {"id": "the id"})}) == ["v1"]
    assert spark.table("v1").schema["id"].metadata["comment"] == "the id"


def test_schema_evolution_is_all_or_nothing(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    wanted = StructType([StructField("id", LongType()), StructField("a", StringType()), StructField("b", StringType())])
    assert upsert.evolve(spark.range(1), wanted, ["a", "b"]).columns == ["id", "a", "b"]
    with pytest.raises(ValueError):
        upsert.evolve(spark.range(1).withColumn("a", F.lit("x")), wanted, ["a", "b"])
