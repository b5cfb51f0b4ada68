"""Small building blocks that the larger operators are made of, each shown once."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from verigrid.operators.scale import with_context
from verigrid.plans.quality import GateError
from verigrid.queries.ingest import CONTRACTS, EVENTS, NAMES, NATIONS, SUPPLIERS, audit, csv_file, folder
from verigrid.queries.mapping import RULES_SQL, STATUS_RULES, STATUS_SCHEMA, status_rules
from verigrid.queries.registry import query
from verigrid.sinks import publish as sink
from verigrid.sinks import upsert
from verigrid.sources import contracts, loader


def money(name):
    return F.col(name).cast("decimal(18,2)")


@query("prj05", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END IS DISTINCT FROM CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS is_distinct FROM orders")
def prj05(t):
    left = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    right = F.when(F.col("o_totalprice") > 100000, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", (~left.eqNullSafe(right)).alias("is_distinct"))


@query("prj06", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def prj06(t):
    return t.customer.drop("c_name", "c_acctbal")


@query("prj10", "SELECT c_custkey, (SELECT CAST(COUNT(*) AS BIGINT) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT MAX(o_orderkey) FROM orders) AS newest_key FROM customer")
def prj10(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    joined = t.customer.select("c_custkey").join(counts, "c_custkey", "left")
    newest = t.orders.agg(F.max("o_orderkey").alias("newest_key"))
    return with_context(joined.withColumn("orders", F.coalesce("orders", F.lit(0))), newest)


@query("prj11", f"WITH {RULES_SQL} SELECT o_orderkey, version, standardized_status FROM orders JOIN status_rules ON source_status = o_orderstatus")
def prj11(t):
    rules = status_rules(t).select("source_status", "version", "standardized_status")
    return t.orders.join(rules, F.col("o_orderstatus") == F.col("source_status")).select("o_orderkey", "version", "standardized_status")


@query("prj12", "SELECT o_orderkey, o_totalprice > 250000 AS is_large FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
def prj12(t):
    first, large = F.lit("1998-01-01").cast("date"), F.lit(250000)
    return t.orders.filter(F.col("o_orderdate") >= first).select("o_orderkey", (F.col("o_totalprice") > large).alias("is_large"))


@query("join01", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join01(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("join02", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 100 AND o_orderstatus = 'F'")
def join02(t):
    residual = (F.col("o_totalprice") > F.col("c_acctbal") * 100) & (F.col("o_orderstatus") == "F")
    return t.customer.join(t.orders, (F.col("o_custkey") == F.col("c_custkey")) & residual, "left").select("c_custkey", "o_orderkey")


@query("join03", "SELECT l_orderkey, a.lines, b.open_lines FROM (SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS lines FROM lineitem GROUP BY 1) a LEFT JOIN (SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS open_lines FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) b USING (l_orderkey)")
def join03(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    opened = t.lineitem.filter("l_linestatus = 'O'").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("open_lines"))
    return lines.join(opened, "l_orderkey", "left")


@query("join07", "SELECT n_name, (SELECT CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) FROM orders) AS snapshot_date, (SELECT CAST(COUNT(*) AS BIGINT) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation")
def join07(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    context = t.orders.agg(F.max("o_orderdate").cast("date").cast("string").alias("snapshot_date"))
    joined = t.nation.join(counts, "n_nationkey", "left").select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"))
    return with_context(joined, context)


@query("agg01", "SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS money, MIN(l_quantity) AS smallest, MAX(l_quantity) AS largest FROM lineitem GROUP BY 1")
def agg01(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).cast("decimal(38,2)").alias("money"),
        F.min("l_quantity").alias("smallest"), F.max("l_quantity").alias("largest"),
    )


@query("agg02", "SELECT o_custkey, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS finished, CAST(COUNT(*) FILTER (WHERE o_totalprice > 200000) AS BIGINT) AS large FROM orders GROUP BY 1")
def agg02(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_totalprice") > 200000).alias("large")
    )


@query("agg11", "SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS BIGINT) AS year, CAST(COUNT(*) AS BIGINT) AS lines FROM lineitem GROUP BY ALL")
def agg11(t):
    year = F.year("l_shipdate").cast("bigint").alias("year")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", year).agg(F.count(F.lit(1)).alias("lines"))


@query("srt01", "SELECT c_mktsegment, CAST(MAX(c_custkey) AS BIGINT) AS newest FROM customer GROUP BY 1 ORDER BY CASE c_mktsegment WHEN 'BUILDING' THEN 0 ELSE 1 END, newest DESC NULLS LAST")
def srt01(t):
    newest = t.customer.groupBy("c_mktsegment").agg(F.max("c_custkey").alias("newest"))
    return newest.orderBy(F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1), F.col("newest").desc_nulls_last())


@query("srt02", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def srt02(t):
    """The newest row is the feature: a take-ordered plan, no full sort."""
    return t.orders.orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1).select("o_orderkey", "o_orderstatus")


@query("set03", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def set03(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("src03", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS event_type_code, props AS props_json_ FROM events")
def src03(t):
    names, renamed = contracts.safe_names(["event_id", "event type code", "props json;"])
    source = t.events.select(F.col("event_id").cast("string"), "event_type", "props")
    if list(renamed.values()) != names:
        raise contracts.ContractError("the rename map must follow the header")
    return source.toDF(*names)


@query("src04", "SELECT 'events_csv' AS source_name, 'details, kind' AS missing_after_drop, CAST(COUNT(*) AS BIGINT) AS rows FROM events")
def src04(t):
    contracts.require_header(EVENTS, t.events.columns)
    missing = contracts.missing_groups(EVENTS, t.events.drop("event_type", "props").columns)
    return t.events.agg(
        F.max(F.lit(EVENTS.name)).alias("source_name"), F.max(F.lit(", ".join(sorted(missing)))).alias("missing_after_drop"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("src05", "SELECT * FROM (VALUES ('c_name', 'REMOVED'), ('balance', 'ADDED'), ('c_acctbal', 'REMOVED')) v(column_name, drift), (SELECT CAST(COUNT(*) AS BIGINT) AS rows FROM customer)")
def src05(t):
    incoming = t.customer.withColumnRenamed("c_acctbal", "balance").drop("c_name")
    drift = contracts.header_drift(t.spark, t.customer.columns, incoming.columns)
    return with_context(drift, incoming.agg(F.count(F.lit(1)).alias("rows")))


SRC15_SQL = """WITH n(source_name, rows) AS (SELECT 'events_csv', COUNT(*) FROM events UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'nation', COUNT(*) FROM nation UNION ALL SELECT 'region', COUNT(*) FROM region UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'supplier', COUNT(*) FROM supplier),
    e(source_name, run_id, status) AS (SELECT source_name, 'run-1', s FROM n, (VALUES ('STARTED'), ('SUCCESS')) v(s) WHERE source_name NOT IN ('orders', 'supplier') UNION ALL SELECT 'orders', 'run-1', s FROM (VALUES ('STARTED'), ('FAILED')) v(s) UNION ALL SELECT 'supplier', 'run-1', s FROM (VALUES ('STARTED'), ('FAILED')) v(s)
        UNION ALL VALUES ('events_csv', 'run-2', 'SKIPPED_IDEMPOTENT'), ('nation', 'run-2', 'FAILED'))
    SELECT e.source_name, e.run_id, e.status, CASE WHEN status IN ('SUCCESS', 'SKIPPED_IDEMPOTENT') THEN n.rows END AS rows_loaded,
        CASE WHEN status = 'FAILED' THEN CASE e.source_name WHEN 'orders' THEN 'no column for money' WHEN 'supplier' THEN 'header occurs once per file' ELSE 'loaded from other files' END END AS reason,
        CASE WHEN e.source_name NOT IN ('orders', 'supplier') THEN n.rows END AS published FROM e JOIN n ON n.source_name = e.source_name"""


@query("src15", SRC15_SQL)
def src15(t):
    """One loader for every contract: loads, a rerun, a missing column, a repeated header and a taken snapshot id."""
    root = folder(t, "landing")

    def text(table, again=False):
        path = folder(t, "csv")
        rows = table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])
        if again:  # a header line in the middle of a file
            rows = t.spark.createDataFrame([table.columns], rows.schema).unionByName(rows)
        rows.write.option("header", True).option("escape", '"').csv(path)
        return path

    def load(contract, path, names, run, snapshot_id=None):
        with contextlib.suppress(contracts.ContractError, loader.SnapshotConflict, GateError):  # the audit log tells
            loader.load(t.spark, path, names, contract, root, run, snapshot_id)

    for contract in CONTRACTS:
        table = getattr(t, contract.table)
        path, names = (csv_file(t), NAMES) if contract is EVENTS else (text(table, contract is SUPPLIERS), table.columns)
        load(contract, path, names, "run-1", "2024-01")
        if contract is EVENTS:
            load(contract, path, names, "run-2", "2024-01")
        if contract is NATIONS:
            load(contract, text(table.limit(9)), names, "run-2", "2024-01")
    log = loader.read_audit(t.spark, root)
    pointers = [(c.name, sink.read_pointer(t.spark, root, c.table)) for c in CONTRACTS]
    state = [(name, pointer["row_count"]) for name, pointer in pointers if pointer]
    published = t.spark.createDataFrame(state, "source_name string, published bigint")
    reason = F.regexp_extract("error_message", "no column for money|header occurs once per file|loaded from other files", 0)
    rows = log.select("source_name", "run_id", "status", "rows_loaded", F.when(reason != "", reason).alias("reason"))
    return rows.join(published, "source_name", "left")


@query("snk07", "SELECT strftime(o_orderdate, '%Y') AS snapshot_id, CAST(COUNT(*) AS BIGINT) AS rows FROM orders GROUP BY 1")
def snk07(t):
    path = folder(t, "evidence")
    log = audit(t)
    sink.append(log.filter("status <> 'FAILED'"), path)
    sink.append(log.filter("status = 'FAILED'"), path)
    return t.spark.read.parquet(path).groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("rows"))


@query("snk09", "SELECT o_orderkey, NULL::BIGINT AS area_key, NULL::VARCHAR AS area_status FROM orders")
def snk09(t):
    wanted = StructType([StructField("o_orderkey", LongType()), StructField("area_key", LongType()), StructField("area_status", StringType())])
    return upsert.evolve(t.orders.select("o_orderkey"), wanted, ["area_key", "area_status"])


@query("snk10", "SELECT c_nationkey, CAST(COUNT(*) AS BIGINT) AS customers FROM customer GROUP BY 1")
def snk10(t):
    text = f"SELECT c_nationkey, COUNT(*) AS customers FROM parquet.`{t.folder}/customer.parquet` GROUP BY c_nationkey"
    comments = {"c_nationkey": "Nation of the customers.", "customers": "Number of customers."}
    sink.publish_catalog_views(t.spark, "mart_", {"mart_customers_by_nation": (text, comments)}, ["mart_old_customers"])
    return t.spark.table("mart_customers_by_nation")


@query("snk11", f"WITH {RULES_SQL} SELECT source_status, version, (SELECT CAST(COUNT(*) AS BIGINT) FROM orders WHERE o_orderstatus = source_status) AS orders FROM status_rules")
def snk11(t):
    """Seeding the same literal rules twice adds nothing."""
    seed = t.spark.createDataFrame(STATUS_RULES, STATUS_SCHEMA)
    seeded = upsert.upsert(upsert.upsert(seed.limit(0), seed, ["source_status", "version"]), seed, ["source_status", "version"])
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("source_status")).agg(F.count(F.lit(1)).alias("orders"))
    return seeded.select("source_status", "version").join(counts, "source_status", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )
