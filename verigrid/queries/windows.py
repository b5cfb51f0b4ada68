"""Row-level window operators on the supplied tables (WIN*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.operators import scale
from verigrid.operators.windows import pct
from verigrid.queries.registry import query
from verigrid.operators.scale import with_context


def money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "win01",
    """SELECT user_id, event_id, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def win01(t):
    events = t.events.select("user_id", "event_id", "event_type", "ts")
    return scale.latest_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query(
    "win02",
    """SELECT user_id, event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events QUALIFY DENSE_RANK() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1""",
)
def win02(t):
    events = t.events.select("user_id", "event_id", F.col("ts").cast("date").cast("string").alias("day"))
    return scale.latest_batch(events, ["user_id"], "day")


@query(
    "win03",
    """SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity, CAST(ROW_NUMBER() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber, l_quantity ORDER BY l_returnflag) AS BIGINT) AS ordinal FROM lineitem""",
)
def win03(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return scale.identical_row_ordinals(rows, "ordinal")


@query(
    "win04",
    """
    WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN CAST(floor(c_acctbal / 100) AS BIGINT) END AS hundreds, c_mktsegment <> 'BUILDING' AS ok FROM customer)
    SELECT c_custkey, c_nationkey, hundreds, CASE WHEN ok THEN CAST(RANK() OVER (PARTITION BY c_nationkey, ok ORDER BY hundreds DESC NULLS LAST) AS BIGINT) END AS balance_rank FROM c""",
)
def win04(t):
    members = t.customer.select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_mktsegment") != "FURNITURE", F.floor(F.col("c_acctbal") / 100)).alias("hundreds"),
        (F.col("c_mktsegment") != "BUILDING").alias("ok"),
    )
    # higher values come first, a missing value last
    block = F.coalesce(-F.floor(F.col("hundreds") / 10), F.lit(2**40))
    ranked = scale.rank_by_value(members, ["c_nationkey"], "hundreds", "balance_rank", block, F.col("ok"))
    return ranked.drop("ok")


@query(
    "win05",
    """
    SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DECIMAL(38,2)) AS running_value, CAST(COUNT(*) OVER w AS BIGINT) AS running_events
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win05(t):
    events = t.events.select("event_id", "user_id", "ts", money("value").alias("amount"))
    scanned = scale.running_values(
        events,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        None,
        {"running_value": F.col("amount"), "running_events": F.lit(1).cast("bigint")},
    )
    return scanned.select(
        "event_id", "user_id", F.col("running_value").cast("decimal(38,2)").alias("running_value"), "running_events"
    )


@query(
    "win06",
    """
    SELECT l_orderkey, l_returnflag, ROUND(100 * CAST(SUM(q) AS DOUBLE) / NULLIF(CAST(SUM(SUM(q)) OVER (PARTITION BY l_returnflag) AS DOUBLE), 0), 4) AS share_of_flag_pct,
        ROUND(100 * CAST(SUM(q) AS DOUBLE) / NULLIF(CAST(SUM(SUM(q)) OVER () AS DOUBLE), 0), 4) AS share_of_all_pct
    FROM (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem) GROUP BY 1, 2""",
)
def win06(t):
    per_order = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.sum(money("l_quantity")).alias("q"))
    shared = scale.attach_group_values(per_order, ["l_returnflag"], {"flag_total": F.sum("q")})
    total = t.lineitem.agg(F.sum(money("l_quantity")).alias("total"))
    shared = shared.transform(with_context, total)
    return shared.select(
        "l_orderkey", "l_returnflag",
        pct(F.col("q"), F.col("flag_total")).alias("share_of_flag_pct"),
        pct(F.col("q"), F.col("total")).alias("share_of_all_pct"),
    )


@query(
    "win07",
    """SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS orders, ROUND(100.0::DOUBLE * COUNT(*) / SUM(COUNT(*)) OVER (), 4) AS pct_of_orders FROM orders GROUP BY 1""",
)
def win07(t):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return scale.attach_total(counts, {"total": F.sum("orders")}).select(
        "o_orderpriority", "orders", pct(F.col("orders"), F.col("total")).alias("pct_of_orders")
    )


CARRY_SQL = """
    WITH marked AS (SELECT event_id, user_id, event_type, ts, CASE event_type WHEN 'signup' THEN {'code': CAST(event_id AS VARCHAR)} WHEN 'error' THEN {'code': NULL::VARCHAR} END AS mark FROM events)
    SELECT event_id, user_id, event_type, LAST_VALUE(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND %s) AS carried FROM marked"""


def marked_events(t):
    kind = F.col("event_type")
    code = F.when(kind == "signup", F.col("event_id").cast("string"))
    return t.events.select("event_id", "user_id", "event_type").withColumn(
        "mark", F.when(kind.isin("signup", "error"), F.struct(code.alias("code")))
    )


@query(
    "win08",
    f"SELECT event_id, user_id, event_type, carried.code AS context, carried IS NOT NULL AS has_context FROM ({CARRY_SQL % 'CURRENT ROW'})",
)
def win08(t):
    carried = scale.carry_forward(
        marked_events(t), ["user_id"], "event_id", None, {"carried": F.col("mark")}
    )
    return carried.select(
        "event_id", "user_id", "event_type", F.col("carried.code").alias("context"),
        F.col("carried").isNotNull().alias("has_context"),
    )


@query(
    "win09",
    f"SELECT event_id, user_id, event_type, carried.code AS context, carried IS NOT NULL AS has_context FROM ({CARRY_SQL % '1 PRECEDING'})",
)
def win09(t):
    carried = scale.carry_forward(
        marked_events(t), ["user_id"], "event_id", None, {"carried": F.col("mark")}, strict=True
    )
    return carried.select(
        "event_id", "user_id", "event_type", F.col("carried.code").alias("context"),
        F.col("carried").isNotNull().alias("has_context"),
    )


@query(
    "win10",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY o_orderpriority = MIN(o_orderpriority) OVER (PARTITION BY o_custkey)""",
)
def win10(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    best = scale.attach_group_values(rows, ["o_custkey"], {"best": F.min("o_orderpriority")})
    return best.filter(F.col("o_orderpriority") == F.col("best")).drop("best")


@query(
    "win11",
    """
    WITH d AS (SELECT o_custkey, COUNT(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS priorities FROM orders GROUP BY 1)
    SELECT o_orderkey, orders.o_custkey, CAST(priorities AS BIGINT) AS settled_priorities FROM orders JOIN d ON orders.o_custkey = d.o_custkey""",
)
def win11(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    counted = scale.attach_group_values(
        rows, ["o_custkey"], {"settled_priorities": F.countDistinct(settled)}
    )
    return counted.select("o_orderkey", "o_custkey", "settled_priorities")


@query(
    "win12",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, MAX(CASE WHEN l_returnflag = 'R' AND l_quantity >= 50 THEN 1 ELSE 0 END) OVER (PARTITION BY l_partkey) = 1 AS is_claimed,
        CAST(COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) OVER (PARTITION BY l_partkey) AS BIGINT) AS claims FROM lineitem""",
)
def win12(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_quantity"
    )
    claim = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50)
    claimed = scale.attach_group_values(
        rows, ["l_partkey"],
        {"is_claimed": F.bool_or(claim), "claims": F.count_if(F.col("l_returnflag") == "A")},
    )
    return claimed.drop("l_returnflag", "l_quantity")


@query(
    "win13",
    """SELECT conv_id, turn, role, turn = MIN(turn) OVER (PARTITION BY conv_id) AS is_first FROM conversations""",
)
def win13(t):
    rows = t.conversations.select("conv_id", "turn", "role")
    first = scale.attach_group_values(rows, ["conv_id"], {"first_turn": F.min("turn")})
    return first.select("conv_id", "turn", "role", (F.col("turn") == F.col("first_turn")).alias("is_first"))


@query(
    "win14",
    """SELECT s_suppkey, s_nationkey, CAST(COUNT(*) OVER (PARTITION BY s_nationkey) AS BIGINT) AS feature_count FROM supplier""",
)
def win14(t):
    return scale.attach_group_values(
        t.supplier.select("s_suppkey", "s_nationkey"), ["s_nationkey"], {"feature_count": F.count(F.lit(1))}
    )


@query(
    "win15",
    """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders QUALIFY year(o_orderdate) = MAX(year(o_orderdate)) OVER ()""",
)
def win15(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    return scale.attach_total(rows, {"newest": F.max("year")}).filter("year = newest").drop("newest")


@query(
    "win16",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, MAX(CASE WHEN l_linestatus = 'O' THEN l_quantity END) OVER (PARTITION BY l_orderkey) AS largest_open FROM lineitem""",
)
def win16(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_linestatus", "l_quantity")
    open_quantity = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    return scale.attach_group_values(rows, ["l_orderkey"], {"largest_open": F.max(open_quantity)}).drop(
        "l_linestatus", "l_quantity"
    )
