"""Joins, aggregations, set operations on the supplied tables (JOIN*, AGG*, SET*, SRT*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.functions import typing
from verigrid.operators import joins, resolve
from verigrid.queries.registry import query
from verigrid.operators.scale import attach_total, lookup, rank_by_value, running_values


def money(name):
    return F.col(name).cast("decimal(18,2)")


def big(expr):
    return expr.cast("decimal(38,2)")


@query(
    "join04",
    """
    WITH a AS (SELECT c_nationkey AS nation, CAST(COUNT(*) AS BIGINT) AS members FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_nationkey <> 3 GROUP BY 1),
         b AS (SELECT s_nationkey AS nation, CAST(COUNT(*) AS BIGINT) AS members FROM supplier GROUP BY 1)
    SELECT coalesce(a.nation, b.nation) AS nation, a.members AS members_left, b.members AS members_right,
        CASE WHEN b.nation IS NULL THEN 'ONLY_LEFT' WHEN a.nation IS NULL THEN 'ONLY_RIGHT' WHEN a.members = b.members THEN 'SAME' ELSE 'DIFFERENT' END AS comparison
    FROM a FULL OUTER JOIN b ON a.nation = b.nation""",
)
def join04(t):
    kept = (F.col("c_mktsegment") != "BUILDING") | (F.col("c_nationkey") != 3)
    a = t.customer.filter(kept).groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("members")
    )
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("members"))
    return joins.two_sided(a, b, ["nation"], ["members"])


@query(
    "join05",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)""",
)
def join05(t):
    large = t.orders.filter("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(large, "c_custkey", "left_anti")


@query(
    "join06",
    """
    WITH o AS (SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS priority, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total FROM orders GROUP BY 1),
    labels(priority, label) AS (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), (NULL, 'unknown'))
    SELECT o.priority, o.total, l.label FROM o LEFT JOIN labels l ON o.priority IS NOT DISTINCT FROM l.priority""",
)
def join06(t):
    priority = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    totals = t.orders.groupBy(priority.alias("priority")).agg(big(F.sum(money("o_totalprice"))).alias("total"))
    labels = t.spark.createDataFrame(
        [("1-URGENT", "now"), ("2-HIGH", "soon"), (None, "unknown")], "priority string, label string"
    )
    return lookup(totals, labels, ["priority"], "left")


@query(
    "join08",
    """
    WITH m AS (SELECT n_nationkey AS nation, o_orderstatus AS status FROM nation CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders)),
    v AS (SELECT c_nationkey AS nation, o_orderstatus AS status, CAST(COUNT(*) AS BIGINT) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
          WHERE o_totalprice > 499000 GROUP BY 1, 2)
    SELECT m.nation, m.status, v.orders FROM m LEFT JOIN v ON m.nation = v.nation AND m.status = v.status""",
)
def join08(t):
    members = t.nation.select(F.col("n_nationkey").alias("nation"))
    classes = t.orders.select(F.col("o_orderstatus").alias("status")).distinct()
    measures = (
        t.orders.filter("o_totalprice > 499000")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), F.col("o_orderstatus").alias("status"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return joins.complete_grid(members, classes, measures, ["nation", "status"])


@query(
    "join11",
    """
    WITH places AS (SELECT concat('1', lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), '000') AS code, r_name AS name FROM region WHERE r_name <> 'EUROPE'
        UNION ALL SELECT concat('1', lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0')), n_name FROM nation
        UNION ALL SELECT concat('1', lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), lpad(CAST(100 + c_custkey % 800 AS VARCHAR), 3, '0')), c_name FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT p.code, p.name, a.code AS parent_code, a.name AS parent_name FROM places p
    LEFT JOIN places a ON a.code = concat(substr(p.code, 1, 3), '000') AND a.code <> p.code""",
)
def join11(t):
    code = F.concat(F.lit("1"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0"))
    regions = t.region.filter("r_name <> 'EUROPE'").select(
        F.concat(code, F.lit("000")).alias("code"), F.col("r_name").alias("name")
    )
    nations = t.nation.select(
        F.concat(
            F.lit("1"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0"),
            F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"),
        ).alias("code"),
        F.col("n_name").alias("name"),
    )
    leaves = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(
            F.lit("1"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0"),
            F.lpad((100 + F.col("c_custkey") % 800).cast("string"), 3, "0"),
        ).alias("code"),
        F.col("c_name").alias("name"),
    )
    places = regions.unionByName(nations).unionByName(leaves)
    parents = places.select(F.col("code").alias("parent_code"), F.col("name").alias("parent_name"))
    wanted = typing.parent_code(F.col("code"), 3, 6)
    return places.join(
        parents, (F.col("parent_code") == wanted) & (F.col("parent_code") != F.col("code")), "left"
    )


@query(
    "join12",
    """SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer
       ON (s_acctbal = c_acctbal) OR (substr(s_name, 10) = substr(c_name, 10))""",
)
def join12(t):
    suppliers = t.supplier.select(
        "s_suppkey", "s_acctbal", F.substring("s_name", 10, 20).alias("s_serial")
    )
    customers = t.customer.select(
        "c_custkey", "c_acctbal", F.substring("c_name", 10, 20).alias("c_serial")
    )
    return joins.any_key_join(
        suppliers, customers, [("s_acctbal", "c_acctbal"), ("s_serial", "c_serial")], "s_suppkey", "c_custkey"
    )


ALIASES = [
    ("BUILDING", "", "ASIA", "T1"), ("BUILDING", "NATION_3", "", "T2"), ("MACHINERY", "NATION_4", "MIDDLE EAST", "T3"),
    ("MACHINERY", "", "", "T4"), ("FURNITURE", "NATION_9", "ASIA", "T5"),
]


@query(
    "join13",
    f"""
    WITH alias(name, nation, region, target) AS (VALUES {', '.join(str(a) for a in ALIASES)}),
    rows AS (SELECT c_custkey, c_mktsegment AS name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT DISTINCT c_custkey, target FROM rows JOIN alias ON rows.name = alias.name AND (alias.nation <> '' OR alias.region <> '')
        AND (alias.nation = '' OR alias.nation = n_name) AND (alias.region = '' OR alias.region = r_name)""",
)
def join13(t):
    rows = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("name"), "n_name", "r_name")
    )
    aliases = t.spark.createDataFrame(ALIASES, "name string, nation string, region string, target string")
    return joins.context_alias_join(
        rows, aliases, "name", {"nation": "n_name", "region": "r_name"}, "c_custkey", "target"
    )


@query(
    "join14",
    """
    SELECT c_custkey, o.o_orderkey AS newest_order, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS newest_date FROM customer LEFT JOIN
      (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON o.o_custkey = c_custkey""",
)
def join14(t):
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("newest_order"), "o_orderdate"
    )
    joined = joins.latest_row_join(
        t.customer.select("c_custkey"), orders, ["c_custkey"], [F.col("o_orderdate"), F.col("newest_order")]
    )
    return joined.select(
        "c_custkey", "newest_order", F.col("o_orderdate").cast("date").cast("string").alias("newest_date")
    )


@query(
    "agg03",
    """
    SELECT l_returnflag, CAST(COUNT(DISTINCT l_orderkey) AS BIGINT) AS orders,
      CAST(COUNT(DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey END) AS BIGINT) AS large_orders,
      CAST(COUNT(DISTINCT {'part': l_partkey, 'line': CASE WHEN l_linestatus = 'O' THEN l_linenumber END}) AS BIGINT) AS part_lines
    FROM lineitem GROUP BY 1""",
)
def agg03(t):
    open_line = F.when(F.col("l_linestatus") == "O", F.col("l_linenumber"))
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct(F.when(F.col("l_quantity") > 25, F.col("l_orderkey"))).alias("large_orders"),
        F.countDistinct(F.struct("l_partkey", open_line.alias("line"))).alias("part_lines"),
    )


@query(
    "agg04",
    """
    SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys, CAST(MAX(n) AS BIGINT) AS largest_group
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def agg04(t):
    groups = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("rows"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.max("n").alias("largest_group"),
    )


@query(
    "agg05",
    """
    WITH d AS (SELECT l_orderkey, COUNT(*) AS n, COUNT(DISTINCT l_returnflag) AS f, MAX(l_returnflag) AS fv, COUNT(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS s,
        MAX(CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS sv FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CAST(n AS BIGINT) AS component_count, CASE WHEN f = 1 THEN fv END AS return_flag, CASE f WHEN 0 THEN 'MISSING' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS return_flag_resolution_status,
      CAST(f AS BIGINT) AS distinct_return_flag_count, CASE WHEN s = 1 THEN sv END AS open_supplier, CASE s WHEN 0 THEN 'MISSING' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS open_supplier_resolution_status, CAST(s AS BIGINT) AS distinct_open_supplier_count FROM d""",
)
def agg05(t):
    return resolve.resolve_attributes(
        t.lineitem,
        ["l_orderkey"],
        {
            "return_flag": F.col("l_returnflag"),
            "open_supplier": F.when(F.col("l_linestatus") == "O", F.col("l_suppkey")),
        },
        distinct_counts=True,
    )


@query(
    "agg06",
    """
    WITH d AS (SELECT l_orderkey, COUNT(*) AS n, COUNT(DISTINCT CASE WHEN l_linestatus = 'F' THEN {'q': l_quantity, 'x': l_discount} END) AS c,
       MAX(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS q, MAX(CASE WHEN l_linestatus = 'F' THEN l_discount END) AS x FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CAST(n AS BIGINT) AS component_count, CASE WHEN c = 1 THEN q END AS lat, CASE WHEN c = 1 THEN x END AS lon, CASE c WHEN 0 THEN 'MISSING_OR_INVALID' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS point_resolution_status FROM d""",
)
def agg06(t):
    valid = F.col("l_linestatus") == "F"
    return resolve.resolve_attributes(
        t.lineitem,
        ["l_orderkey"],
        {},
        pairs={"point": {"lat": F.when(valid, F.col("l_quantity")), "lon": F.when(valid, F.col("l_discount"))}},
        missing={"point": "MISSING_OR_INVALID"},
    )


@query(
    "agg07",
    """
    WITH d AS (SELECT l_orderkey, COUNT(*) AS n, COUNT(m) AS v, COUNT(DISTINCT m) AS c, MAX(m) AS mv FROM
        (SELECT l_orderkey, CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) END AS m FROM lineitem) GROUP BY 1)
    SELECT l_orderkey, CAST(n AS BIGINT) AS component_count, CASE WHEN c = 1 THEN mv END AS budget, CAST(v AS BIGINT) AS valid_budget_count,
      CASE WHEN c = 0 THEN 'MISSING' WHEN c = 1 AND v = 1 THEN 'RESOLVED_SINGLE' WHEN c = 1 THEN 'RESOLVED_REPEATED_IDENTICAL' ELSE 'CONFLICT' END AS budget_resolution_status FROM d""",
)
def agg07(t):
    return resolve.resolve_attributes(
        t.lineitem,
        ["l_orderkey"],
        {},
        money={"budget": F.when(F.col("l_returnflag") != "N", money("l_quantity"))},
    )


@query(
    "agg08",
    """
    SELECT l_orderkey, array_to_string(list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))), ',') AS flags FROM lineitem GROUP BY 1""",
)
def agg08(t):
    flagged = t.lineitem.select("l_orderkey", F.array("l_returnflag", "l_linestatus").alias("pair"))
    return resolve.union_of_arrays(flagged, ["l_orderkey"], {"flags": "pair"}).select(
        "l_orderkey", F.array_join("flags", ",").alias("flags")
    )


@query(
    "agg09",
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS newest_type, CAST(COUNT(*) AS BIGINT) AS events FROM events GROUP BY 1""",
)
def agg09(t):
    return t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("newest_type"),
        F.count(F.lit(1)).alias("events"),
    )


@query(
    "agg10",
    """
    SELECT coalesce(event_type, 'ALL') AS event_type, CAST(grouping(event_type) AS BIGINT) AS is_all, CAST(COUNT(*) AS BIGINT) AS events,
      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total FROM events GROUP BY GROUPING SETS ((event_type), ())""",
)
def agg10(t):
    return t.events.groupingSets([["event_type"], []], "event_type").agg(
        F.grouping("event_type").cast("bigint").alias("is_all"),
        F.count(F.lit(1)).alias("events"),
        big(F.sum(money("value"))).alias("total"),
    ).withColumn("event_type", F.coalesce("event_type", F.lit("ALL")))


LINE_TEXTS = {
    **{c: "CAST({} AS VARCHAR)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")},
    **{c: "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
    "l_returnflag": "{}", "l_linestatus": "{}", "l_shipdate": "strftime({}, '%Y-%m-%d %H:%M:%S')",
}
_TOLD = ", ".join(f"coalesce(concat(length({x.format(c)}), ':', {x.format(c)}), '-')" for c, x in LINE_TEXTS.items())


def line_texts(t):
    """Every column of lineitem in the text form that both engines share."""
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    shown = money | {"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")}
    return t.lineitem.select(*[shown.get(c, F.col(c)).cast("string").alias(c) for c in LINE_TEXTS])


@query(
    "agg12",
    f"""WITH d AS (SELECT l_returnflag, l_orderkey, l_linenumber, md5(concat({_TOLD})) AS d FROM lineitem)
    SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(('0x' || substr(d, 1, 15))::BIGINT) AS VARCHAR) AS mark_low, CAST(SUM(('0x' || substr(d, 16, 15))::BIGINT) AS VARCHAR) AS mark_high,
        CAST(COUNT(*) FILTER (WHERE l_orderkey % 1000 = 1 AND l_linenumber = 1) AS BIGINT) AS repeated_rows_found, CAST(COUNT(*) FILTER (WHERE l_orderkey % 1000 = 2) AS BIGINT) AS changed_rows_found FROM d GROUP BY 1""",
)
def agg12(t):
    """Marks over all columns; against a copy with rows written three times and changed cells, the broken keys are found."""
    lines = line_texts(t)
    order, number = F.col("l_orderkey").cast("bigint") % 1000, F.col("l_linenumber")
    marks = resolve.multiset_marks(lines, ["l_returnflag"], lines.columns)
    # an exclusive or would not see the two rows more
    spoiled = lines.withColumn("l_tax", F.when(order == 2, F.concat("l_tax", F.lit("1"))).otherwise(F.col("l_tax")))
    more = spoiled.filter((order == 1) & (number == "1"))
    spoiled = spoiled.unionByName(more).unionByName(more)
    keys = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    found = resolve.differing_keys(lines, spoiled, keys, [c for c in lines.columns if c not in keys])
    found = found.groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("left_rows") < F.col("right_rows"), F.col("left_rows"))).alias("repeated"),
        F.sum(F.when(F.col("left_rows") == F.col("right_rows"), F.col("left_rows"))).alias("changed"),
    )
    return marks.join(found, "l_returnflag", "left").select(
        "l_returnflag", F.col("mark_rows").alias("rows"), F.col("mark_low").cast("string").alias("mark_low"), F.col("mark_high").cast("string").alias("mark_high"),
        F.coalesce("repeated", F.lit(0)).alias("repeated_rows_found"), F.coalesce("changed", F.lit(0)).alias("changed_rows_found"),
    )


@query(
    "agg14",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1""",
)
def agg14(t):
    return t.orders.groupBy("o_custkey").agg(
        resolve.distinct_text(F.col("o_orderpriority")).alias("priorities")
    )


@query(
    "agg15",
    """
    SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS finished, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS open,
      CAST(COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS other, CAST(COUNT(*) AS BIGINT) AS audited_rows, TRUE AS is_reconciled FROM orders""",
)
def agg15(t):
    status = F.col("o_orderstatus")
    audited = t.orders.agg(F.count("o_orderkey").alias("audited_rows"))
    return resolve.accounting(
        t.orders,
        {"finished": status == "F", "open": status == "O", "other": ~status.isin("F", "O")},
        audited,
    )


@query(
    "agg16",
    """
    SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) - COUNT(l_orderkey) AS BIGINT) AS null_keys, CAST(COUNT(DISTINCT l_returnflag) AS BIGINT) AS flags,
      MIN(l_quantity) AS min_quantity, MAX(l_quantity) AS max_quantity, CAST(COUNT(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.09) AS BIGINT) AS bad_discount,
      CAST(CAST(MIN(l_shipdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(MAX(l_shipdate) AS DATE) AS VARCHAR) AS last_day FROM lineitem""",
)
def agg16(t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count("l_orderkey")).alias("null_keys"),
        F.size(F.collect_set("l_returnflag")).cast("bigint").alias("flags"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
        F.count_if((F.col("l_discount") < 0) | (F.col("l_discount") > 0.09)).alias("bad_discount"),
        F.min("l_shipdate").cast("date").cast("string").alias("first_day"),
        F.max("l_shipdate").cast("date").cast("string").alias("last_day"),
    )


@query(
    "set01",
    """SELECT 'CUSTOMER' AS party_type, c_custkey AS party_key, c_nationkey AS nation, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'SUPPLIER', s_suppkey, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), NULL FROM supplier""",
)
def set01(t):
    customers = t.customer.select(
        F.lit("CUSTOMER").alias("party_type"), F.col("c_custkey").alias("party_key"),
        F.col("c_nationkey").alias("nation"), money("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.lit("SUPPLIER").alias("party_type"), F.col("s_suppkey").alias("party_key"),
        F.col("s_nationkey").alias("nation"), money("s_acctbal").alias("balance"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "set02",
    """SELECT l_returnflag AS code FROM lineitem UNION SELECT o_orderstatus FROM orders UNION SELECT upper(event_type) FROM events""",
)
def set02(t):
    parts = [
        t.lineitem.select(F.col("l_returnflag").alias("code")),
        t.orders.select(F.col("o_orderstatus").alias("code")),
        t.events.select(F.upper("event_type").alias("code")),
    ]
    # each side is made distinct on its own, so only vocabularies are shuffled together
    union = parts[0].distinct()
    for part in parts[1:]:
        union = union.union(part.distinct())
    return union.distinct()


@query(
    "set04",
    """
    WITH seen AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS covered FROM orders GROUP BY 1)
    SELECT o_custkey, array_to_string(list_sort(list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], lambda p: NOT list_contains(covered, p))), ',') AS missing FROM seen""",
)
def set04(t):
    expected = F.array(*[F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(
            F.array_sort(F.array_except(expected, F.collect_set("o_orderpriority"))), ","
        ).alias("missing")
    )


@query(
    "srt03",
    """
    WITH c AS (SELECT o_orderstatus AS status, c_nationkey AS nation, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY status ORDER BY total DESC, nation) AS place, SUM(total) OVER (PARTITION BY status ORDER BY total DESC, nation ROWS UNBOUNDED PRECEDING) AS running, SUM(total) OVER (PARTITION BY status) AS all_total FROM c)
    SELECT status, nation, CAST(place AS BIGINT) AS place, CAST(total AS DECIMAL(38,2)) AS total, ROUND(100 * CAST(running AS DOUBLE) / CAST(all_total AS DOUBLE), 4) AS cumulative_share_pct FROM r WHERE place <= 3""",
)
def srt03(t):
    from verigrid.operators.windows import concentration

    totals = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("c_nationkey").alias("nation"))
        .agg(F.sum(money("o_totalprice")).alias("total"))
    )
    return concentration(totals, ["status"], "total", "nation").filter("place <= 3").select(
        "status", "nation", "place", big(F.col("total")).alias("total"), "cumulative_share_pct"
    )
