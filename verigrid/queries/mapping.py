"""Governed mappings on the supplied tables (MAP*, MAT20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.functions import text
from verigrid.operators import mapping, resolve
from verigrid.queries.registry import query
from verigrid.operators.scale import with_context

# token, sector, flag, version, approval, active
TOKEN_RULES = [
    ("red", "Finish", False, "v2", "APPROVED", True), ("blue", "Finish", False, "v2", "APPROVED", True),
    ("hot", "Finish", True, "v2", "APPROVED", True), ("cold", "Finish", False, "v2", "APPROVED", True),
    ("small", "Sizing", False, "v2", "APPROVED", True), ("large", "Sizing", True, "v2", "APPROVED", True),
    ("gear", "Hardware", False, "v2", "APPROVED", True), ("bolt", "Hardware", False, "v2", "APPROVED", True),
    ("ring", "Hardware", False, "v2", "APPROVED", True), ("plate", "Structure", True, "v2", "APPROVED", True),
    ("rod", "Structure", False, "v2", "APPROVED", True), ("widget", "Hardware", False, "v2", "APPROVED", True),
    ("new", "Finish", False, "v2", "PENDING_REVIEW", True), ("old", "Finish", False, "v1", "APPROVED", False),
]
TOKEN_SCHEMA = "token string, sector string, is_flagged boolean, version string, approval_status string, is_active boolean"

STATUS_RULES = [
    ("F", "Completed", "INACTIVE", "s3", "APPROVED", True), ("O", "On-Going", "ACTIVE", "s3", "APPROVED", True),
    ("P", "Pending", "ACTIVE", "s3", "PENDING_REVIEW", True), ("O", "Open", "ACTIVE", "s2", "APPROVED", False),
]
STATUS_SCHEMA = "source_status string, standardized_status string, status_group string, version string, approval_status string, is_active boolean"


def values(rows) -> str:
    def literal(v):
        return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


RULES_SQL = f"""
    token_rules(token, sector, is_flagged, version, approval_status, is_active) AS (VALUES {values(TOKEN_RULES)}),
    status_rules(source_status, standardized_status, status_group, version, approval_status, is_active) AS (VALUES {values(STATUS_RULES)})"""


def token_rules(t):
    return t.spark.createDataFrame(TOKEN_RULES, TOKEN_SCHEMA)


def status_rules(t):
    return t.spark.createDataFrame(STATUS_RULES, STATUS_SCHEMA)


def acting_tokens(t):
    return mapping.active_mapping(token_rules(t), "version", ["token"])


def acting_statuses(t):
    return mapping.active_mapping(status_rules(t), "version", ["source_status"])


def part_tokens(t):
    """Part categories: one word for small parts, none for the largest, both otherwise."""
    listed = (
        F.when(F.col("p_size") == 50, "")
        .when(F.col("p_size") < 20, F.substring_index("p_name", " ", -1))
        .otherwise(F.regexp_replace("p_name", " ", ","))
    )
    return t.part.select("p_partkey", text.tokens(listed).alias("tokens"))


PART_TOKENS_SQL = """
    part_tokens AS (SELECT p_partkey, CASE WHEN p_size = 50 THEN []::VARCHAR[] WHEN p_size < 20 THEN [split_part(p_name, ' ', 2)]
        ELSE list_sort(list_distinct(string_split(p_name, ' '))) END AS tokens FROM part)"""


def classified_sql(key: str, source: str) -> str:
    return f"""
    tok AS (SELECT {key}, unnest(tokens) AS token FROM {source}),
    agg AS (SELECT {key}, COUNT(*) AS n, COUNT(r.token) AS ok, MIN(r.sector) AS sector, MAX(CASE WHEN r.is_flagged THEN 1 ELSE 0 END) AS flag,
        string_agg(DISTINCT CASE WHEN r.token IS NULL THEN tok.token END, ',' ORDER BY CASE WHEN r.token IS NULL THEN tok.token END) AS bad
        FROM tok LEFT JOIN token_rules r ON r.token = tok.token AND r.approval_status = 'APPROVED' AND r.is_active GROUP BY 1),
    classified AS (SELECT s.{key}, array_to_string(s.tokens, '|') AS tokens, CASE WHEN n = ok AND n = 1 THEN sector WHEN n = ok THEN 'Multi-sector' END AS standardized_sector,
        CASE WHEN n = ok THEN flag = 1 END AS is_flagged, CASE WHEN n = ok THEN 'MAPPED' ELSE 'UNMAPPED' END AS category_mapping_state,
        CASE WHEN n IS NULL THEN 'MISSING_SOURCE_CATEGORY' WHEN n <> ok THEN 'UNAPPROVED_SOURCE_CATEGORY' WHEN n = 1 THEN 'MAPPED_SINGLE' ELSE 'MAPPED_MULTI' END AS category_classification_status,
        coalesce(bad, '') AS unapproved_tokens FROM {source} s LEFT JOIN agg ON agg.{key} = s.{key})"""


def as_text(df):
    return df.withColumns(
        {"tokens": F.array_join("tokens", "|"), "unapproved_tokens": F.array_join("unapproved_tokens", ",")}
    )


@query(
    "map01",
    f"""
    WITH {RULES_SQL}, acting AS (SELECT * FROM status_rules WHERE approval_status = 'APPROVED' AND is_active)
    SELECT o_orderstatus AS source_status, CAST(COUNT(*) AS BIGINT) AS orders, MAX(standardized_status) AS standardized_status, MAX(version) AS version,
       (SELECT CASE WHEN COUNT(*) = 0 THEN 'NO_ACTIVE_VERSION' WHEN COUNT(DISTINCT version) > 1 THEN 'MANY_ACTIVE_VERSIONS' WHEN COUNT(*) <> COUNT(DISTINCT source_status) THEN 'FAN_OUT_KEY' ELSE 'OK' END FROM acting) AS mapping_state
    FROM orders LEFT JOIN acting ON source_status = o_orderstatus GROUP BY 1""",
)
def map01(t):
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("source_status")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    acting = acting_statuses(t).select("source_status", "standardized_status", "version")
    state = mapping.mapping_state(status_rules(t), "version", ["source_status"]).select("mapping_state")
    return counts.join(acting, "source_status", "left").transform(with_context, state)


@query(
    "map02",
    f"""
    WITH {RULES_SQL}
    SELECT o_orderkey, o_orderstatus, standardized_status, status_group, CASE WHEN source_status IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END AS mapping_state
    FROM orders LEFT JOIN (SELECT * FROM status_rules WHERE approval_status = 'APPROVED' AND is_active) ON source_status = o_orderstatus""",
)
def map02(t):
    return mapping.apply_mapping(
        t.orders.select("o_orderkey", "o_orderstatus"), acting_statuses(t),
        {"o_orderstatus": "source_status"}, ["standardized_status", "status_group"],
    )


@query("map03", f"WITH {RULES_SQL}, {PART_TOKENS_SQL}, {classified_sql('p_partkey', 'part_tokens')} SELECT * FROM classified")
def map03(t):
    return as_text(mapping.classify_tokens(part_tokens(t), "tokens", acting_tokens(t)))


@query(
    "map04",
    f"""
    WITH {RULES_SQL}, {PART_TOKENS_SQL},
    order_tokens AS (SELECT l_orderkey, list_sort(list_distinct(flatten(list(tokens)))) AS tokens FROM lineitem JOIN part_tokens ON l_partkey = p_partkey GROUP BY 1),
    {classified_sql('l_orderkey', 'order_tokens')} SELECT * FROM classified""",
)
def map04(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(
        part_tokens(t), F.col("l_partkey") == F.col("p_partkey")
    )
    sets = resolve.union_of_arrays(lines, ["l_orderkey"], {"tokens": "tokens"})
    return as_text(mapping.classify_tokens(sets, "tokens", acting_tokens(t)))


@query(
    "map05",
    f"""
    WITH {RULES_SQL}, {PART_TOKENS_SQL},
    raw AS (SELECT 'part_category' AS mapping_domain, token AS raw_value, CAST(COUNT(*) AS BIGINT) AS source_rows FROM (SELECT unnest(tokens) AS token FROM part_tokens) GROUP BY 2
        UNION ALL SELECT 'order_status', o_orderstatus, COUNT(*) FROM orders GROUP BY 2),
    rules AS (SELECT 'part_category' AS d, token AS v, approval_status, version FROM token_rules WHERE is_active UNION ALL SELECT 'order_status', source_status, approval_status, version FROM status_rules WHERE is_active)
    SELECT mapping_domain, raw_value, source_rows, coalesce(approval_status, 'UNMAPPED') AS review_state, version AS mapping_version,
        CASE WHEN approval_status = 'APPROVED' THEN 'READY' ELSE 'REVIEW_REQUIRED' END AS coverage_status
    FROM raw LEFT JOIN rules ON d = mapping_domain AND v = raw_value""",
)
def map05(t):
    words = part_tokens(t).select(F.explode("tokens").alias("token"))
    return mapping.mapping_coverage(
        words, token_rules(t), "part_category", "token", "token", "version"
    ).unionByName(
        mapping.mapping_coverage(
            t.orders, status_rules(t), "order_status", "o_orderstatus", "source_status", "version"
        )
    )


@query(
    "map06",
    """
    WITH m AS (SELECT concat(event_type, '-', props) AS k, CASE WHEN value > 300 THEN 'PENDING_REVIEW' ELSE 'APPROVED' END AS s, value < 400 AS a, strftime(ts, '%Y-%m') AS v FROM events),
    n AS (SELECT o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'PENDING_REVIEW' ELSE 'APPROVED' END AS s, TRUE AS a, strftime(o_orderdate, '%Y-%m') AS v FROM orders)
    SELECT 'event_rules' AS mapping_table, CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(*) FILTER (WHERE s = 'APPROVED' AND a) AS BIGINT) AS active_approved_rows, CAST(COUNT(*) FILTER (WHERE s = 'PENDING_REVIEW') AS BIGINT) AS pending_rows, MAX(v) AS newest_version FROM m
    UNION ALL SELECT 'order_rules', COUNT(*), COUNT(*) FILTER (WHERE s = 'APPROVED' AND a), COUNT(*) FILTER (WHERE s = 'PENDING_REVIEW'), MAX(v) FROM n""",
)
def map06(t):
    events = t.events.select(
        F.when(F.col("value") > 300, "PENDING_REVIEW").otherwise("APPROVED").alias("approval_status"),
        (F.col("value") < 400).alias("is_active"), F.date_format("ts", "yyyy-MM").alias("version"),
    )
    orders = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", "PENDING_REVIEW").otherwise("APPROVED").alias("approval_status"),
        F.lit(True).alias("is_active"), F.date_format("o_orderdate", "yyyy-MM").alias("version"),
    )
    return mapping.mapping_inventory({"event_rules": (events, "version"), "order_rules": (orders, "version")})


@query(
    "mat20",
    f"""
    WITH {RULES_SQL}, l AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'P' ELSE l_linestatus END AS raw FROM lineitem),
    m AS (SELECT l_orderkey, raw, standardized_status, status_group FROM l LEFT JOIN (SELECT * FROM status_rules WHERE approval_status = 'APPROVED' AND is_active) ON raw = source_status WHERE raw IS NOT NULL),
    g AS (SELECT l_orderkey, COUNT(DISTINCT raw) AS n, COUNT(DISTINCT {{'a': standardized_status, 'b': status_group}}) AS k, MAX(standardized_status) AS s, MAX(status_group) AS grp FROM m GROUP BY 1),
    o AS (SELECT DISTINCT l_orderkey FROM lineitem)
    SELECT o.l_orderkey, CASE WHEN n = 1 AND k = 1 THEN s END AS standardized_status, CASE WHEN n = 1 AND k = 1 AND s IS NOT NULL THEN grp END AS status_group,
        CASE WHEN n = 1 AND k = 1 AND s IS NOT NULL AND grp IS NOT NULL THEN 'MAPPED' ELSE 'UNMAPPED' END AS status_mapping_state FROM o LEFT JOIN g ON g.l_orderkey = o.l_orderkey""",
)
def mat20(t):
    flag = F.col("l_returnflag")
    raw = F.when(flag == "N", None).when((flag == "R") & (F.col("l_quantity") > 40), "P").otherwise(
        F.col("l_linestatus")
    )
    lines = mapping.apply_mapping(
        t.lineitem.select("l_orderkey", raw.alias("raw")), acting_statuses(t),
        {"raw": "source_status"}, ["standardized_status", "status_group"],
    )
    return mapping.publish_status(
        lines, ["l_orderkey"], F.col("raw"),
        {"standardized_status": F.col("standardized_status"), "status_group": F.col("status_group")},
    )
