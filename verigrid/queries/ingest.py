"""Ingestion and sinks on the supplied tables (SRC*, SNK*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verigrid.functions import identity
from verigrid.plans.quality import GateError, checks, in_range, not_null
from verigrid.queries.registry import query
from verigrid.session import work_dir
from verigrid.sinks import publish as sink
from verigrid.sinks import upsert
from verigrid.sinks.stage import materialize
from verigrid.sources import contracts, dump_rows, loader, snapshot
from verigrid.operators.scale import with_context

EVENTS = contracts.SourceContract(
    "events_csv", "events", {"id": ["event_id", "id"], "kind": ["EVENT_TYPE"], "details": ["props", "payload"]}, version="2024-01", multi_line=True
)
ORDERS = contracts.SourceContract("orders", "orders", {"id": ["o_orderkey"], "money": ["amount", "total"]})
NATIONS = contracts.SourceContract("nation", "nation", {"id": ["N_NATIONKEY"], "name": ["n_name"]}, expected_rows=25)
REGIONS = contracts.SourceContract("region", "region", {"id": ["r_regionkey"], "name": ["R_NAME"]}, expected_rows=5)
CUSTOMERS = contracts.SourceContract("customer", "customer", {"id": ["c_custkey"], "nation": ["c_nationkey"]}, version="2")
SUPPLIERS = contracts.SourceContract("supplier", "supplier", {"id": ["s_suppkey"], "balance": ["s_acctbal", "balance"]})
CONTRACTS = (EVENTS, ORDERS, NATIONS, REGIONS, CUSTOMERS, SUPPLIERS)
NAMES = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENT_SQL = """CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value"""


def folder(t, label):
    return f"{work_dir(t.spark)}/{label}-{uuid.uuid4().hex}"


def as_strings(t, broken=False):
    """All columns of events as texts; ``broken`` writes each JSON text over several lines."""
    props = F.replace(F.col("props"), F.lit(": "), F.lit(":\n ")) if broken else F.col("props")
    ts, value = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("value").cast("decimal(18,2)")
    texts = {"ts": ts, "value": value, "props": props}
    return t.events.select(*[texts.get(c, F.col(c)).cast("string").alias(c) for c in NAMES])


def csv_file(t):
    """Fields hold line breaks, so records are longer than lines."""
    path = folder(t, "csv")
    as_strings(t, True).write.option("header", True).option("escape", '"').csv(path)
    return path


def line_file(t):
    """The same rows as lines that end in CR LF, a header in each file."""
    path = folder(t, "lines")
    as_strings(t).write.option("header", True).option("escape", '"').option("lineSep", "\r\n").csv(path)
    return path


@query("src01", f"SELECT {EVENT_SQL}, replace(props, ': ', ':' || chr(10) || ' ') AS props FROM events")
def src01(t):
    names, _ = contracts.safe_names(NAMES)
    contracts.require_header(EVENTS, names)
    return snapshot.scan_csv(t.spark, csv_file(t), names, EVENTS)


@query("src02", f"SELECT {EVENT_SQL}, props FROM events")
def src02(t):
    """Lines are split at the line feed; the carriage return before it is no part of a record."""
    return snapshot.scan_lines(t.spark, line_file(t), NAMES)


@query("src06", "SELECT TRUE AS same_on_rerun, TRUE AS differs_by_version, TRUE AS has_files FROM (SELECT COUNT(*) FROM events)")
def src06(t):
    path = csv_file(t)
    other = contracts.SourceContract(EVENTS.name, EVENTS.table, EVENTS.groups, version="2024-02")
    a = snapshot.snapshot_identity(t.spark, path, EVENTS).select(F.col("snapshot_id").alias("a"), "file_count")
    b = snapshot.snapshot_identity(t.spark, path, EVENTS).select(F.col("snapshot_id").alias("b"))
    c = snapshot.snapshot_identity(t.spark, path, other).select(F.col("snapshot_id").alias("c"))
    return a.transform(with_context, b).transform(with_context, c).select(
        (F.col("a") == F.col("b")).alias("same_on_rerun"), (F.col("a") != F.col("c")).alias("differs_by_version"),
        (F.col("file_count") > 0).alias("has_files"),
    )


def landed(t):
    path = csv_file(t)
    scan = snapshot.scan_csv(t.spark, path, NAMES, EVENTS)
    return snapshot.stamp_lineage(scan, EVENTS, snapshot.snapshot_identity(t.spark, path, EVENTS), "run-1", "2024-02-01 00:00:00")


@query(
    "src07",
    """SELECT event_type, CAST(COUNT(*) AS BIGINT) AS rows, 'events_csv' AS source_name, 'run-1' AS ingest_run_id, '2024-02-01' AS ingested_on, CAST(10 AS BIGINT) AS lineage_columns, TRUE AS identity_is_single, CAST(0 AS BIGINT) AS identity_nulls FROM events GROUP BY 1""",
)
def src07(t):
    rows = materialize(landed(t), "landed")  # read by two aggregates
    stamped = [c for c in rows.columns if c in contracts.LINEAGE_COLUMNS]
    state = snapshot.table_state(rows, ["_source_snapshot_id", "_source_name", "_source_path"])
    counted = rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_source_name").alias("source_name"),
        F.max("_ingest_run_id").alias("ingest_run_id"),
        F.max("_ingested_at").cast("date").cast("string").alias("ingested_on"),
        F.max(F.lit(len(stamped)).cast("bigint")).alias("lineage_columns"),
    )
    return counted.transform(with_context, state.select("identity_is_single", "identity_nulls"))


@query(
    "src08",
    """SELECT check_name, CAST(0 AS BIGINT) AS failed_rows, 'PASS' AS status, (SELECT CAST(COUNT(*) AS BIGINT) FROM events) AS parsed_rows FROM (VALUES ('source has data rows'), ('written rows equal parsed rows'), ('parsed rows equal file records'), ('header occurs once per file')) v(check_name)""",
)
def src08(t):
    path, out = line_file(t), folder(t, "landed")
    parsed, watch = snapshot.observed(snapshot.scan_lines(t.spark, path, NAMES), "landing")
    parsed.write.parquet(out)
    count = watch.get["parsed_rows"]
    lines = snapshot.header_lines(t.spark, path, NAMES)
    results = snapshot.reconcile_rows(t.spark.read.parquet(out), count, lines, "events")
    return results.select("check_name", "failed_rows", "status", F.lit(count).cast("bigint").alias("parsed_rows"))


def audit(t):
    """Orders as load attempts: a customer is a source, a year is a snapshot id."""
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("source_name"), F.date_format("o_orderdate", "yyyy").alias("snapshot_id"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"),
        F.when(status == "F", "SUCCESS").when(status == "O", "SKIPPED_IDEMPOTENT").otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.when(status != "P", F.col("o_orderdate")).alias("completed_at"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor("o_totalprice")).alias("rows_loaded"),
        F.substring("o_orderpriority", 1, 1).alias("file_mark"),
    )


AUDIT_SQL = """
    audit AS (SELECT CAST(o_custkey AS VARCHAR) AS source_name, strftime(o_orderdate, '%Y') AS snapshot_id, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'SKIPPED_IDEMPOTENT' ELSE 'FAILED' END AS status, o_orderdate AS ev,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT) END AS rows_loaded, substr(o_orderpriority, 1, 1) AS file_mark FROM orders)"""


@query(
    "src09",
    f"""WITH {AUDIT_SQL}, req AS (SELECT source_name, snapshot_id, MAX(file_mark) AS file_mark FROM audit GROUP BY 1, 2),
    cl AS (SELECT * FROM audit WHERE status <> 'FAILED' QUALIFY ROW_NUMBER() OVER (PARTITION BY source_name, snapshot_id ORDER BY ev, run_id) = 1), lr AS (SELECT * FROM audit WHERE status <> 'FAILED' AND rows_loaded IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY source_name, snapshot_id ORDER BY ev DESC, run_id DESC) = 1)
    SELECT r.source_name, r.snapshot_id, CASE WHEN c.run_id IS NULL THEN 'LOAD' WHEN c.file_mark <> r.file_mark THEN 'CONFLICT' WHEN coalesce(l.rows_loaded, 0) <= 0 THEN 'LOAD' ELSE 'SKIPPED_IDEMPOTENT' END AS decision, c.run_id AS claimed_by FROM req r LEFT JOIN cl c ON c.source_name = r.source_name AND c.snapshot_id = r.snapshot_id LEFT JOIN lr l ON l.source_name = r.source_name AND l.snapshot_id = r.snapshot_id""",
)
def src09(t):
    log = audit(t)
    requested = log.groupBy("source_name", "snapshot_id").agg(F.max("file_mark").alias("file_mark"))
    return snapshot.load_decision(log, requested, ["file_mark"])


@query(
    "src10",
    f"""WITH {AUDIT_SQL} SELECT status, CAST(COUNT(*) AS BIGINT) AS events, MIN(run_id) AS first_run, MAX(run_id) AS last_run, CAST(COUNT(*) FILTER (status = 'FAILED') AS BIGINT) AS with_error FROM audit GROUP BY 1
        UNION ALL SELECT 'STARTED', COUNT(*), MIN(run_id), MAX(run_id), 0 FROM audit WHERE status <> 'SKIPPED_IDEMPOTENT'""",
)
def src10(t):
    """Each attempt's events in the fixed schema: a start for what was loaded, then how it ended."""
    path = folder(t, "audit")
    log = audit(t)
    names = [field.split() for field in loader.AUDIT_SCHEMA.split(", ")]
    fixed = lambda df: df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in names])
    failed = F.when(F.col("status") == "FAILED", F.concat(F.lit("load of "), "snapshot_id", F.lit(" failed")))
    begun = log.filter("status <> 'SKIPPED_IDEMPOTENT'").withColumns({"status": F.lit("STARTED"), "completed_at": F.lit(None), "rows_loaded": F.lit(None)})
    sink.append(fixed(begun), path)
    for status in ("SUCCESS", "SKIPPED_IDEMPOTENT", "FAILED"):
        sink.append(fixed(log.filter(F.col("status") == status).withColumn("error_message", failed)), path)
    return t.spark.read.schema(loader.AUDIT_SCHEMA).parquet(path).groupBy("status").agg(
        F.count(F.lit(1)).alias("events"), F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run"),
        F.count("error_message").alias("with_error"),
    )


@query("src11", "SELECT o_orderpriority AS priority, CAST(COUNT(*) AS BIGINT) AS orders, 'GATE_STOPPED' AS second_publish FROM orders GROUP BY 1")
def src11(t):
    """A second publish with spoiled rows fails its checks; readers still see the first."""
    root = folder(t, "published")
    good = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("orders"))
    spoiled = good.withColumn("orders", F.when(F.col("priority") != "5-LOW", F.col("orders")))
    rule = lambda df: checks(df, "orders_by_priority", not_null("orders"))
    sink.publish(good, root, "orders_by_priority", "run-1", rule)
    outcome = "PUBLISHED"
    try:
        sink.publish(spoiled, root, "orders_by_priority", "run-2", rule)
    except GateError:
        outcome = "GATE_STOPPED"
    current = sink.read_published(t.spark, root, "orders_by_priority")
    return current.withColumn("second_publish", F.lit(outcome))


@query(
    "src12",
    """SELECT 'events_csv' AS source_name, CAST(COUNT(*) AS BIGINT) AS row_count, '' AS missing_columns, 'READY' AS precheck_status FROM events UNION ALL SELECT 'orders', COUNT(*), 'money', 'MISSING_COLUMNS' FROM orders UNION ALL SELECT 'nation', COUNT(*), '', CASE WHEN COUNT(*) = 25 THEN 'READY' ELSE 'UNEXPECTED_ROW_COUNT' END FROM nation""",
)
def src12(t):
    out = None
    for contract, df in ((EVENTS, t.events), (ORDERS, t.orders), (NATIONS, t.nation)):
        part = contracts.precheck(df, contract)
        out = part if out is None else out.unionByName(part)
    return out


DUMP_SQL = r"""
    lines AS (SELECT doc_id AS sheet, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS row_no FROM documents),
    cells AS (SELECT sheet, row_no, list_slice(list_concat(string_split(line, '|'), ['', '', '']), 1, 3) AS c FROM lines),
    flags AS (SELECT *, row_no <= 0 AS title, trim(c[1]) = '' AND trim(c[2]) = '' AND trim(c[3]) = '' AS blank, length(trim(c[1])) > 40 AS data, length(trim(c[1])) < 15 AS opens FROM cells),
    noted AS (SELECT *, MIN(CASE WHEN NOT title AND NOT blank AND NOT data AND opens THEN row_no END) OVER (PARTITION BY sheet) AS notes_from FROM flags),
    roles AS (SELECT sheet, CASE WHEN title THEN 'TITLE' WHEN blank THEN 'BLANK' WHEN data THEN 'DATA' WHEN row_no >= notes_from AND trim(c[2]) = '' AND trim(c[3]) = '' THEN 'NOTE' ELSE 'ISSUE' END AS row_role FROM noted)"""


@query(
    "src13",
    f"""WITH {DUMP_SQL} SELECT sheet, CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(*) FILTER (WHERE row_role = 'TITLE') AS BIGINT) AS title_rows, CAST(COUNT(*) FILTER (WHERE row_role = 'BLANK') AS BIGINT) AS blank_rows, CAST(COUNT(*) FILTER (WHERE row_role = 'DATA') AS BIGINT) AS data_rows, CAST(COUNT(*) FILTER (WHERE row_role = 'NOTE') AS BIGINT) AS note_rows, CAST(COUNT(*) FILTER (WHERE row_role = 'ISSUE') AS BIGINT) AS issue_rows, TRUE AS adds_up FROM roles GROUP BY 1""",
)
def src13(t):
    """Documents as sheets, their lines as rows, '|' as the cell border."""
    lines = t.documents.select(
        F.lit("dump").alias("file"), F.col("doc_id").alias("sheet"), F.posexplode(F.split("text", "\n", -1)).alias("row_no", "line")
    )
    padded = F.concat(F.split("line", r"\|", -1), F.array(F.lit(""), F.lit(""), F.lit("")))
    rows = lines.select("file", "sheet", "row_no", padded.alias("cells"))
    first = F.length(F.trim(F.col("table_cells")[0]))
    classified = dump_rows.classify_dump_rows(rows, 0, 3, first > 40, first < 15)
    return dump_rows.manifest(classified).drop("file")


@query("snk01", "SELECT o_orderstatus AS status, CAST(COUNT(*) AS BIGINT) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS money FROM orders GROUP BY 1")
def snk01(t):
    root = folder(t, "full")
    table = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("money")
    )
    sink.publish(table.filter("status <> 'P'"), root, "orders_by_status", "run-1")
    sink.publish(table, root, "orders_by_status", "run-2")
    return sink.read_published(t.spark, root, "orders_by_status")


SIDES_SQL = """
    old AS (SELECT o_orderkey AS k, o_orderpriority AS p, CAST(o_totalprice AS DECIMAL(18,2)) AS m, DATE '1998-12-31' AS seen FROM orders WHERE o_orderdate < DATE '1999-01-01'),
    new AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN '0-DONE' ELSE o_orderpriority END AS p, CAST(o_totalprice AS DECIMAL(18,2)) AS m, DATE '1999-12-31' AS seen FROM orders WHERE o_orderdate >= DATE '1997-01-01')"""


def sides(t):
    """Two overlapping snapshots of orders; finished ones changed their priority in the newer."""
    money = F.col("o_totalprice").cast("decimal(18,2)").alias("m")
    old = t.orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("date")).select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), money, F.lit("1998-12-31").alias("seen")
    )
    changed = F.when(F.col("o_orderstatus") == "F", "0-DONE").otherwise(F.col("o_orderpriority"))
    new = t.orders.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")).select(
        F.col("o_orderkey").alias("k"), changed.alias("p"), money, F.lit("1999-12-31").alias("seen")
    )
    return old, new


@query("snk02", f"WITH {SIDES_SQL} SELECT k, p, m, CAST(seen AS VARCHAR) AS seen FROM new UNION ALL SELECT k, p, m, CAST(seen AS VARCHAR) FROM old WHERE k NOT IN (SELECT k FROM new)")
def snk02(t):
    old, new = sides(t)
    return upsert.upsert(old, new, ["k"])


@query(
    "snk03",
    f"""WITH {SIDES_SQL} SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL OR (n.k IS NOT NULL AND (o.p IS DISTINCT FROM n.p OR o.m IS DISTINCT FROM n.m)) THEN n.p ELSE o.p END AS p, coalesce(o.m, n.m) AS m, CAST(CASE WHEN o.k IS NULL OR (n.k IS NOT NULL AND (o.p IS DISTINCT FROM n.p OR o.m IS DISTINCT FROM n.m)) THEN n.seen ELSE o.seen END AS VARCHAR) AS seen FROM old o FULL JOIN new n ON n.k = o.k""",
)
def snk03(t):
    old, new = sides(t)
    return upsert.upsert_if_changed(old, new, ["k"], ["p", "m"])


@query(
    "snk04",
    f"""WITH {SIDES_SQL} SELECT k, p, m, CAST(seen AS VARCHAR) AS seen, length(p) AS label_size FROM new UNION ALL SELECT k, p, m, CAST(seen AS VARCHAR), NULL FROM old WHERE k NOT IN (SELECT k FROM new)""",
)
def snk04(t):
    old, new = sides(t)
    return upsert.upsert(old, new.withColumn("label_size", F.length("p")), ["k"], allow_new_columns=True)


@query(
    "snk05",
    f"""WITH {SIDES_SQL} SELECT coalesce(n.k, o.k) AS k, coalesce(n.p, o.p) AS p, coalesce(n.m, o.m) AS m, CAST(coalesce(n.seen, o.seen) AS VARCHAR) AS seen, n.k IS NOT NULL AS is_current FROM old o FULL JOIN new n ON n.k = o.k""",
)
def snk05(t):
    old, new = sides(t)
    mark = lambda df: df.withColumn("is_current", F.lit(True))
    return upsert.snapshot_upsert(mark(old), mark(new), ["k"], "is_current", "seen")


@query("snk06", "SELECT CAST(COUNT(*) AS BIGINT) AS rows, 'PUBLISHED' AS first_run, 'SKIPPED_CURRENT' AS same_run, 'PUBLISHED' AS next_run FROM orders")
def snk06(t):
    root = folder(t, "skip")
    table = t.orders.select("o_orderkey", "o_orderstatus")
    first, _ = sink.publish(table, root, "orders", "run-a")
    again, _ = sink.publish(table, root, "orders", "run-a")
    later, rows = sink.publish(table, root, "orders", "run-b")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.lit(first)).alias("first_run"), F.max(F.lit(again)).alias("same_run"),
        F.max(F.lit(later)).alias("next_run"),
    )


@query(
    "snk08",
    """SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS version, o_orderstatus <> 'P' AND year(o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders) AS is_active FROM orders""",
)
def snk08(t):
    rows = t.orders.select(
        "o_orderkey", "o_orderpriority", F.year("o_orderdate").cast("bigint").alias("version"), (F.col("o_orderstatus") != "P").alias("is_active")
    )
    newest = rows.agg(F.max("version").alias("newest"))
    return upsert.retire_older_versions(rows.transform(with_context, newest), "version", F.col("newest")).drop("newest")
