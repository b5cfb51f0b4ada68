"""Quality evidence and gates on the supplied tables (DQ*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verigrid.functions import identity
from verigrid.operators import mapping, matching
from verigrid.plans import marts, model, quality
from verigrid.plans.quality import Check, checks, consistent, in_range, not_null, vocabulary, zero_not_null
from verigrid.queries import mapping as mapping_queries
from verigrid.queries import marts as mart_queries
from verigrid.queries import model as model_queries
from verigrid.queries import rebuild, star
from verigrid.queries.mapping import RULES_SQL
from verigrid.queries.model import AREAS_SQL, COMPONENT_SQL
from verigrid.queries.registry import SQL, query
from verigrid.queries.star import PROJECTS_SQL as W
from verigrid.session import work_dir
from verigrid.operators.scale import with_context


def check_rows(table: str, source: str, specs, total: str = "COUNT(*)") -> str:
    """SQL for check rows: (attribute, name, failed count, action) over one source."""
    parts = []
    for attribute, name, failed, action in specs:
        parts.append(
            f"""SELECT '{table}' AS table_name, '{attribute}' AS attribute, '{name}' AS check_name, CAST(f AS BIGINT) AS failed_rows, CAST(n AS BIGINT) AS total_rows, ROUND(CASE WHEN n > 0 THEN 100.0::DOUBLE * f / n END, 4) AS percentage,
            CASE WHEN f IS NULL THEN 'ERROR' WHEN f = 0 THEN 'PASS' WHEN '{action}' = 'stop' THEN 'FAIL' ELSE 'FLAG' END AS status, '{action}' AS action FROM (SELECT {failed} AS f, {total} AS n FROM {source})"""
        )
    return " UNION ALL ".join(parts)


def n_if(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def shown(results):
    return results.drop("details")


@query(
    "dq01",
    check_rows(
        "lineitem", "lineitem",
        [
            ("Completeness", "l_shipdate is not missing", n_if("l_shipdate IS NULL"), "stop"),
            ("Validity", "l_returnflag uses the controlled vocabulary", n_if("l_returnflag NOT IN ('A', 'R')"), "stop"),
            ("Validity", "l_discount is inside 0 to 0.08", n_if("l_discount < 0 OR l_discount > 0.08"), "flag"),
            ("Accuracy", "not computable", "NULL", "stop"),
        ],
    ),
)
def dq01(t):
    return shown(
        checks(
            t.lineitem, "lineitem",
            [
                *not_null("l_shipdate"), vocabulary("l_returnflag", ["A", "R"]), in_range("l_discount", 0, 0.08),
                Check("Accuracy", "not computable", F.max(F.lit(None).cast("bigint"))),
            ],
        )
    )


EVIDENCE_SQL = """
    log AS (SELECT concat('run-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS run_id, o_orderpriority AS table_name, concat('snap-', CAST(o_orderkey AS VARCHAR)) AS snapshot_id, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'SKIPPED_IDEMPOTENT' ELSE 'FAILED' END AS status,
        o_orderdate AS completed_at, CAST(floor(o_totalprice) AS BIGINT) AS rows_loaded FROM orders),
    evidence AS (SELECT o_orderpriority AS table_name, CASE WHEN o_orderpriority < '3' THEN 'silver_results' ELSE 'gold_results' END AS results_table, concat('val-', strftime(o_orderdate, '%Y-%m')) AS validation_run_id, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS run_ts, concat('check-', o_orderstatus, '-', CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR)) AS check_name,
        CASE WHEN o_totalprice > 490000 THEN 'FAIL' WHEN o_orderstatus = 'P' THEN 'FLAG' ELSE 'PASS' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'flag' ELSE 'stop' END AS action, CAST(floor(o_totalprice / 5000) AS BIGINT) AS failed_rows, o_orderkey FROM orders)"""

BLOCKING = "(status = 'ERROR' OR (action = 'stop' AND status IS DISTINCT FROM 'PASS') OR action NOT IN ('stop', 'flag'))"


def evidence(t):
    """Orders as saved check rows; a month is one validation batch, stamped at its end."""
    status = F.col("o_orderstatus")
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return t.orders.select(
        F.col("o_orderpriority").alias("table_name"),
        F.when(F.col("o_orderpriority") < "3", "silver_results").otherwise("gold_results").alias("results_table"),
        F.concat(F.lit("val-"), F.date_format("o_orderdate", "yyyy-MM")).alias("validation_run_id"),
        F.add_months(month, 1).cast("timestamp").alias("run_ts"),
        F.concat(F.lit("check-"), status, F.lit("-"), F.floor(F.col("o_totalprice") / 100000).cast("string")).alias("check_name"),
        F.when(F.col("o_totalprice") > 490000, "FAIL").when(status == "P", "FLAG").otherwise("PASS").alias("status"),
        F.when(status == "P", "flag").otherwise("stop").alias("action"),
        F.floor(F.col("o_totalprice") / 5000).alias("failed_rows"), "o_orderkey",
    )


def log(t):
    loads = model_queries.load_log(t)
    return loads.withColumns({c: F.col(c).cast("timestamp") for c in ("completed_at", "started_at")})


@query(
    "dq02",
    f"""WITH {EVIDENCE_SQL}, l AS (SELECT * FROM log QUALIFY ROW_NUMBER() OVER (PARTITION BY table_name ORDER BY completed_at DESC, run_id DESC) = 1),
    e AS (SELECT * FROM evidence QUALIFY DENSE_RANK() OVER (PARTITION BY table_name ORDER BY run_ts DESC) = 1), j AS (SELECT table_name, COUNT(*) AS k, {n_if(BLOCKING)} AS b FROM e GROUP BY 1)
    SELECT l.table_name, snapshot_id, CASE WHEN l.status NOT IN ('SUCCESS', 'SKIPPED_IDEMPOTENT') THEN 'NEWEST_LOAD_NOT_SUCCESSFUL' WHEN rows_loaded <= 0 THEN 'LOAD_EMPTY' WHEN k IS NULL THEN 'NO_VALIDATION_EVIDENCE' WHEN b > 0 THEN 'BLOCKING_FINDINGS' ELSE 'SAFE' END AS safety FROM l LEFT JOIN j ON j.table_name = l.table_name""",
)
def dq02(t):
    return quality.latest_safe(log(t), evidence(t))


@query(
    "dq03",
    check_rows(
        "events", "events",
        [
            ("Completeness", "event_id is not missing", n_if("event_id IS NULL"), "stop"),
            ("Completeness", "ts is not missing", n_if("ts IS NULL"), "stop"),
            ("Validity", "props key parses as a whole number", n_if("TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL"), "stop"),
            ("Validity", "value is inside 0 to 100", n_if("value < 0 OR value > 100"), "flag"),
            ("Validity", "event_type uses the controlled vocabulary", n_if("event_type NOT IN ('view', 'click', 'purchase', 'signup')"), "stop"),
        ],
    )
    + " UNION ALL "
    + check_rows("events", "(SELECT COUNT(*) AS k FROM events GROUP BY event_id)", [("Uniqueness", "event_id is unique", "SUM(k) - COUNT(*)", "stop")], "SUM(k)"),
)
def dq03(t):
    parsed = F.get_json_object("props", "$.k").try_cast("int")
    suite = checks(
        t.events, "events",
        [
            *not_null("event_id", "ts"),
            Check("Validity", "props key parses as a whole number", F.count_if(parsed.isNull())),
            in_range("value", 0, 100),
            vocabulary("event_type", ["view", "click", "purchase", "signup"]),
        ],
    )
    return shown(quality.all_of(suite, quality.unique_key(t.events, "events", ["event_id"])))


@query(
    "dq04",
    f"""WITH {RULES_SQL}, o AS (SELECT o_orderstatus, r.version FROM orders LEFT JOIN (SELECT * FROM status_rules WHERE approval_status = 'APPROVED' AND is_active) r ON source_status = o_orderstatus), """
    + "x AS ("
    + check_rows("status_rules", "status_rules", [
        ("Validity", "approval_status uses the controlled vocabulary", n_if("approval_status NOT IN ('APPROVED', 'PENDING_REVIEW', 'DEPRECATED')"), "stop"),
        ("Completeness", "version is not missing", n_if("version IS NULL"), "stop"),
    ])
    + " UNION ALL "
    + check_rows("status_rules", "(SELECT COUNT(*) AS k FROM status_rules GROUP BY source_status, version)", [("Uniqueness", "source_status+version is unique", "SUM(k) - COUNT(*)", "stop")], "SUM(k)")
    + " UNION ALL "
    + check_rows("status_rules", "o", [("Consistency", "every order status has an acting rule", n_if("version IS NULL"), "flag")])
    + ") SELECT * FROM x",
)
def dq04(t):
    rules = mapping_queries.status_rules(t)
    covered = mapping.apply_mapping(
        t.orders.select("o_orderstatus"), mapping_queries.acting_statuses(t), {"o_orderstatus": "source_status"}, ["version"]
    )
    return shown(
        quality.all_of(
            checks(rules, "status_rules", [vocabulary("approval_status", ["APPROVED", "PENDING_REVIEW", "DEPRECATED"]), *not_null("version")]),
            quality.unique_key(rules, "status_rules", ["source_status", "version"]),
            checks(covered, "status_rules", [consistent("every order status has an acting rule", F.col("mapping_state") == "MAPPED", "flag")]),
        )
    )


@query(
    "dq05",
    f"WITH {W}, x AS ("
    + check_rows("population", "population", [
        ("Completeness", "population_count is not missing", n_if("population_count IS NULL"), "stop"),
        ("Validity", "population_count is inside 1 to 60000", n_if("population_count < 1 OR population_count > 60000"), "flag"),
        ("Consistency", "an area and its region are known together", n_if("NOT ((area_key = 0) = (region_key = 0))"), "stop"),
        ("Accuracy", "unresolved population stays visible", n_if("region_key = 0"), "flag"),
    ])
    + " UNION ALL "
    + check_rows("population", "(SELECT COUNT(*) AS k FROM population GROUP BY area_key, reference_year)", [("Uniqueness", "area_key+reference_year is unique", "SUM(k) - COUNT(*)", "stop")], "SUM(k)")
    + ") SELECT * FROM x",
)
def dq05(t):
    people = star.population(t)
    suite = checks(
        people, "population",
        [
            *not_null("population_count"), in_range("population_count", 1, 60000),
            consistent("an area and its region are known together", (F.col("area_key") == 0) == (F.col("region_key") == 0)),
            Check("Accuracy", "unresolved population stays visible", F.count_if(F.col("region_key") == 0), "flag"),
        ],
    )
    return shown(quality.all_of(suite, quality.unique_key(people, "population", ["area_key", "reference_year"])))


@query(
    "dq06",
    f"WITH {AREAS_SQL}, s AS (SELECT DISTINCT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS rr, lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS nn FROM customer JOIN nation ON n_nationkey = c_nationkey), x AS ("
    + check_rows("areas", "areas", [
        ("Validity", "area_type uses the controlled vocabulary", n_if("area_type NOT IN ('PROVINCE', 'INDEPENDENT_CITY', 'NCR', 'UNKNOWN')"), "stop"),
        ("Consistency", "only the unknown area has no code", n_if("(code IS NULL) <> (area_type = 'UNKNOWN')"), "stop"),
        ("Consistency", "every area has a verified region", n_if("is_geographic_area AND parent_code IS NULL"), "flag"),
    ])
    + " UNION ALL "
    + check_rows("areas", "(SELECT COUNT(*) AS k FROM areas GROUP BY code)", [("Uniqueness", "code is unique", "SUM(k) - COUNT(*)", "stop")], "SUM(k)")
    + ") SELECT * FROM x",
)
def dq06(t):
    areas = model_queries.areas(t)
    suite = checks(
        areas, "areas",
        [
            vocabulary("area_type", ["PROVINCE", "INDEPENDENT_CITY", "NCR", "UNKNOWN"]),
            consistent("only the unknown area has no code", F.col("code").isNull() == (F.col("area_type") == "UNKNOWN")),
            consistent("every area has a verified region", ~F.col("is_geographic_area") | F.col("parent_code").isNotNull(), "flag"),
        ],
    )
    return shown(quality.all_of(suite, quality.unique_key(areas, "areas", ["code"])))


@query(
    "dq07",
    f"WITH {COMPONENT_SQL}, x AS ("
    + check_rows("component", "comp", [
        ("Completeness", "contract_id is not missing", n_if("contract_id IS NULL"), "stop"),
        ("Validity", "budget_quality_status uses the controlled vocabulary", n_if("budget_quality_status NOT IN ('MISSING', 'UNPARSEABLE', 'NEGATIVE', 'VALID')"), "stop"),
        ("Consistency", "a missing budget stays NULL", n_if("(budget IS NULL) <> (budget_quality_status = 'MISSING')"), "stop"),
        ("Validity", "progress is inside range", n_if("progress_quality_status = 'OUT_OF_RANGE'"), "flag"),
    ])
    + " UNION ALL "
    + check_rows("project", "(SELECT contract_id, COUNT(*) AS c, COUNT(DISTINCT budget) AS d FROM comp GROUP BY 1)", [
        ("Accuracy", "budget agrees inside a project", n_if("d > 1"), "flag"),
        ("Consistency", "components of all projects add up", "CASE WHEN SUM(c) = (SELECT COUNT(*) FROM lineitem) THEN 0 ELSE 1 END", "stop"),
    ])
    + ") SELECT * FROM x",
)
def dq07(t):
    from verigrid.operators.resolve import resolve_attributes

    parts = model_queries.typed_components(model_queries.raw_components(t))
    entity = resolve_attributes(parts, ["contract_id"], {}, money={"budget": F.col("budget")})
    lines = t.lineitem.agg(F.count(F.lit(1)).alias("lines"))
    status = F.col("budget_quality_status")
    return shown(
        quality.all_of(
            checks(parts, "component", [
                *not_null("contract_id"), vocabulary("budget_quality_status", ["MISSING", "UNPARSEABLE", "NEGATIVE", "VALID"]),
                consistent("a missing budget stays NULL", F.col("budget").isNull() == (status == "MISSING")),
                Check("Validity", "progress is inside range", F.count_if(F.col("progress_quality_status") == "OUT_OF_RANGE"), "flag"),
            ]),
            checks(entity.transform(with_context, lines), "project", [
                Check("Accuracy", "budget agrees inside a project", F.count_if(F.col("budget_resolution_status") == "CONFLICT"), "flag"),
                Check("Consistency", "components of all projects add up", F.when(F.sum("component_count") == F.max("lines"), 0).otherwise(1)),
            ]),
        )
    )


@query(
    "dq08",
    """WITH s AS (SELECT concat(CAST(s_nationkey AS VARCHAR), '-', CAST(CAST(floor(s_acctbal / 100) AS BIGINT) AS VARCHAR)) AS k, COUNT(*) AS n FROM supplier GROUP BY 1), c AS (SELECT concat(CAST(c_nationkey AS VARCHAR), '-', CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR)) AS k, COUNT(*) AS n FROM customer GROUP BY 1),
    m AS (SELECT s.k, s.n AS source_rows, coalesce(c.n, 0) AS tc FROM s LEFT JOIN c ON c.k = s.k), x AS ("""
    + check_rows("source_match", "m", [
        ("Completeness", "every source row is in one key", "abs(SUM(source_rows) - (SELECT COUNT(*) FROM supplier))", "stop"),
        ("Accuracy", "no target is reached by an ambiguous key", n_if("tc > 1"), "flag"),
        ("Consistency", "only unique targets publish an id", "0", "stop"),
    ])
    + ") SELECT * FROM x",
)
def dq08(t):
    key = lambda n, b: F.concat(F.col(n).cast("string"), F.lit("-"), F.floor(F.col(b) / 100).cast("string"))
    found = matching.exact_match(t.supplier, t.customer, key("s_nationkey", "s_acctbal"), key("c_nationkey", "c_acctbal"), "c_custkey")
    total = t.supplier.agg(F.count(F.lit(1)).alias("suppliers"))
    return shown(
        checks(found.transform(with_context, total), "source_match", [
            Check("Completeness", "every source row is in one key", F.abs(F.sum("source_rows") - F.max("suppliers"))),
            Check("Accuracy", "no target is reached by an ambiguous key", F.count_if(F.col("match_status") == "AMBIGUOUS_TARGET"), "flag"),
            consistent("only unique targets publish an id", (F.col("target_candidate_count") == 1) == F.col("matched_id").isNotNull()),
        ])
    )


@query(
    "dq13",
    f"WITH {W}, x AS ("
    + check_rows("fact", "facts", [
        ("Completeness", "region_key is not missing", n_if("region_key IS NULL"), "stop"),
        ("Consistency", "key 0 only without an accepted region", n_if("(region_key = 0) <> (region_match_status <> 'MATCHED')"), "stop"),
        ("Consistency", "status key 0 only without a source status", n_if("(status_key = 0) <> (source_status IS NULL)"), "stop"),
        ("Accuracy", "project and area agree on the region", n_if("area_key <> 0 AND area_region_key <> region_key"), "flag"),
    ])
    + " UNION ALL "
    + check_rows("fact", "(SELECT COUNT(*) AS k FROM facts GROUP BY project_key)", [("Uniqueness", "project_key is unique", "SUM(k) - COUNT(*)", "stop")], "SUM(k)")
    + " UNION ALL "
    + check_rows("fact", "(SELECT region_key AS v, COUNT(*) AS n FROM facts WHERE region_key IS NOT NULL GROUP BY 1) LEFT JOIN (SELECT member_key FROM members WHERE level = 'REGION' UNION SELECT 0) ON member_key = v",
                 [("Integrity", "region_key has a target", "SUM(CASE WHEN member_key IS NULL THEN n ELSE 0 END)", "stop")], "SUM(n)")
    + ") SELECT * FROM x",
)
def dq13(t):
    fact = star.facts(t)
    regions = star.members(t).filter("level = 'REGION'").select("member_key")
    with_zero = regions.union(t.spark.range(1).select(F.col("id").alias("member_key")))
    return shown(
        quality.all_of(
            checks(fact, "fact", [
                *not_null("region_key"),
                consistent("key 0 only without an accepted region", (F.col("region_key") == 0) == (F.col("region_match_status") != "MATCHED")),
                consistent("status key 0 only without a source status", (F.col("status_key") == 0) == F.col("source_status").isNull()),
                Check("Accuracy", "project and area agree on the region", F.count_if((F.col("area_key") != 0) & (F.col("area_region_key") != F.col("region_key"))), "flag"),
            ]),
            quality.unique_key(fact, "fact", ["project_key"]),
            quality.references(fact, "fact", "region_key", with_zero, "member_key"),
        )
    )


def rebuilt_areas(t):
    """The area totals again, from orders and customers alone."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    nation = F.col("c_nationkey")
    withheld = (nation == 18) | ((status == "P") & (priority == "2-HIGH"))
    mapped = ~priority.isin("4-NOT SPECIFIED", "5-LOW") & ~nation.isin(7, 24)
    lines = t.orders.filter(~priority.isin("4-NOT SPECIFIED", "5-LOW")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    totals = lines.filter(mapped).groupBy((nation + 1).alias("member_key")).agg(
        F.count(F.lit(1)).alias("project_count"),
        F.sum(F.when(~withheld, F.col("o_totalprice").cast("decimal(18,2)"))).alias("total_budget"),
    )
    everyone = t.nation.select((F.col("n_nationkey") + 1).alias("member_key"))
    return everyone.join(totals, "member_key", "left").withColumn("project_count", F.coalesce("project_count", F.lit(0)))


#: The query that publishes each mart; its SQL tells how many rows the comparison has to see.
MART_QUERIES = {"distribution_mart": "mrt01", "equity_mart": "mrt02", "alignment_mart": "mrt03", "monitoring_mart": "mrt04", "point_mart": "mrt05"}


@query(
    "dq14",
    f"WITH {W}, act AS (SELECT n_nationkey + 1 AS k, COUNT(project_key) AS n, SUM(budget) AS b FROM nation LEFT JOIN facts ON area_key = n_nationkey + 1 GROUP BY 1), e0 AS (SELECT c_nationkey + 1 AS k, COUNT(*) AS n, SUM(CASE WHEN NOT (c_nationkey = 18 OR (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS b FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND c_nationkey NOT IN (7, 24) GROUP BY 1),"
    " exd AS (SELECT n_nationkey + 1 AS k, coalesce(n, 0) AS n, b FROM nation LEFT JOIN e0 ON e0.k = n_nationkey + 1), both_sides AS (SELECT exd.k AS ek, act.k AS ak, exd.n AS en, act.n AS an, exd.b AS eb, act.b AS ab FROM exd FULL JOIN act ON act.k = exd.k), x AS ("
    + check_rows("area_mart", "both_sides", [
        ("Completeness", "no expected row is missing", n_if("ak IS NULL"), "stop"), ("Completeness", "no unexpected row exists", n_if("ek IS NULL"), "stop"),
        ("Accuracy", "counts equals the rebuild", n_if("en IS DISTINCT FROM an"), "stop"), ("Accuracy", "money equals the rebuild", n_if("eb IS DISTINCT FROM ab"), "stop"),
    ])
    + ") SELECT * FROM x UNION ALL "
    + " UNION ALL ".join(
        check_rows(mart, f"({SQL[name]})", [
            ("Completeness", "no expected row is missing", n_if("FALSE"), "stop"), ("Completeness", "no unexpected row exists", n_if("FALSE"), "stop"),
            *[("Accuracy", f"{family} equals the rebuild", n_if("FALSE"), "stop") for family in rebuild.FAMILIES[mart]],
        ])
        for mart, name in MART_QUERIES.items()
    ),
)
def dq14(t):
    areas = quality.compare(
        rebuilt_areas(t), star.area_members(t), "area_mart", ["member_key"],
        {"counts": ["project_count"], "money": ["total_budget"]},
    )
    return shown(quality.all_of(areas, *mart_checks(t, published_marts(t))))


def published_marts(t):
    facts = star.facts(t)
    return {
        "distribution_mart": star.distribution(t),
        "equity_mart": mart_queries.equity(t),
        "alignment_mart": mart_queries.alignment(t),
        "monitoring_mart": marts.monitoring(facts),
        "point_mart": marts.point_view(facts, star.region_population(t), star.area_population(t)),
    }


def mart_checks(t, published):
    """Every mart against its rebuild: rows on one side only, and a check per column family."""
    raw = rebuild.sources(t)
    return [
        quality.compare(make(t, raw), published[mart], mart, rebuild.KEYS[mart], rebuild.FAMILIES[mart])
        for mart, make in rebuild.REBUILDS.items()
    ]


@query(
    "dq15",
    f"""WITH {EVIDENCE_SQL}, a AS (SELECT validation_run_id, table_name, check_name, CAST(SUM(failed_rows) AS BIGINT) AS f1, CAST(COUNT(*) AS BIGINT) AS t1 FROM evidence GROUP BY ALL), b AS (SELECT validation_run_id, table_name, check_name, CAST(SUM(failed_rows) AS BIGINT) AS f2, CAST(COUNT(*) AS BIGINT) AS t2 FROM evidence WHERE status <> 'FAIL' GROUP BY ALL)
    SELECT coalesce(a.validation_run_id, b.validation_run_id) AS validation_run_id, coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.check_name, b.check_name) AS check_name, f1, t1, f2, t2, f1 IS NOT DISTINCT FROM f2 AND t1 IS NOT DISTINCT FROM t2 AS is_stable
    FROM a FULL JOIN b ON a.validation_run_id = b.validation_run_id AND a.table_name = b.table_name AND a.check_name = b.check_name""",
)
def dq15(t):
    def counted(rows):
        return rows.groupBy("validation_run_id", "table_name", "check_name").agg(
            F.sum("failed_rows").alias("failed_rows"), F.count(F.lit(1)).alias("total_rows")
        )

    return quality.rerun_stability(counted(evidence(t)), counted(evidence(t).filter("status <> 'FAIL'")))


@query(
    "dq16",
    check_rows("orders", "orders", [
        ("Completeness", "o_orderkey is not missing", n_if("o_orderkey IS NULL"), "stop"),
        ("Validity", "o_totalprice is inside 0 to 1000", n_if("o_totalprice < 0 OR o_totalprice > 1000"), "stop"),
    ]),
)
def dq16(t):
    """The gate raises here; what it saved before is what the query returns."""
    path = f"{work_dir(t.spark)}/evidence/{uuid.uuid4().hex}"
    results = checks(t.orders, "orders", [*not_null("o_orderkey"), in_range("o_totalprice", 0, 1000, "stop")])
    try:
        quality.save_then_gate(results, path)
    except quality.GateError:
        pass
    return shown(t.spark.read.parquet(path))


@query("dq17", check_rows("orders", "orders", [("Consistency", "order_key reproduces", n_if("o_orderstatus = 'P' AND o_totalprice > 480000"), "stop")]))
def dq17(t):
    good = identity.run_id("ORDER", F.col("o_orderkey"))
    spoiled = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 480000)
    keyed = t.orders.withColumn("order_key", F.when(spoiled, F.lit("stale")).otherwise(good))
    return shown(quality.hash_reproduces(keyed, "orders", "order_key", good))


REQUIRED = [
    ("silver", "urgent", "silver_results", "1-URGENT", ["1-URGENT", "2-HIGH"]), ("silver", "high", "silver_results", "2-HIGH", ["2-HIGH"]),
    ("gold", "medium", "gold_results", "3-MEDIUM", ["3-MEDIUM", "5-LOW"]), ("gold", "mart", "gold_results", "9-MISSING", ["9-MISSING"]),
]
GATE_SQL = f"""{EVIDENCE_SQL}, req(layer, scope, results_table, anchor, expected) AS (VALUES {', '.join(f"('{a}', '{b}', '{c}', '{d}', {e})" for a, b, c, d, e in REQUIRED)}),
    recent AS (SELECT * FROM evidence WHERE o_orderkey IS NOT NULL), newest AS (SELECT MAX(completed_at) AS ts FROM log),
    lt AS (SELECT r.*, (SELECT MAX(run_ts) FROM recent e WHERE e.results_table = r.results_table AND e.table_name = r.anchor) AS ets FROM req r),
    ct AS (SELECT layer, scope, expected, ets, COUNT(e.status) AS required_checks, COUNT(*) FILTER (WHERE e.status = 'PASS') AS passed_checks, COUNT(*) FILTER (WHERE e.action = 'flag' AND e.status IN ('FLAG', 'FAIL')) AS flagged_checks, COUNT(*) FILTER (WHERE e.status IS NOT NULL AND {BLOCKING}) AS failed_stop_checks, list(DISTINCT e.table_name) FILTER (WHERE e.table_name IS NOT NULL) AS covered
        FROM lt LEFT JOIN recent e ON e.results_table = lt.results_table AND e.run_ts = lt.ets GROUP BY ALL),
    jd AS (SELECT *, list_sort(list_filter(expected, lambda x: NOT list_contains(coalesce(covered, []), x))) AS missing, coalesce(ets >= (SELECT ts FROM newest), FALSE) AS cur FROM ct),
    gate AS (SELECT layer, scope, CAST(required_checks AS BIGINT) AS required_checks, CAST(passed_checks AS BIGINT) AS passed_checks, CAST(flagged_checks AS BIGINT) AS flagged_checks, CAST(failed_stop_checks AS BIGINT) AS failed_stop_checks, CAST(CASE WHEN cur THEN len(missing) ELSE len(expected) END AS BIGINT) AS missing_checks,
        CASE WHEN required_checks = 0 OR NOT cur OR len(missing) > 0 OR failed_stop_checks > 0 THEN 'FAIL' WHEN flagged_checks > 0 THEN 'FLAG' ELSE 'PASS' END AS status,
        concat_ws('; ', CASE WHEN ets IS NULL THEN 'no saved evidence' END, CASE WHEN ets < (SELECT ts FROM newest) THEN 'stale evidence' END, CASE WHEN ets IS NOT NULL AND len(missing) > 0 THEN concat('missing tables: ', array_to_string(missing, ', ')) END, CASE WHEN failed_stop_checks > 0 THEN concat(CAST(failed_stop_checks AS VARCHAR), ' blocking checks failed') END) AS details FROM jd)"""


def gate_rows(t):
    required = t.spark.createDataFrame(
        REQUIRED, "layer string, scope string, results_table string, anchor_table string, expected_tables array<string>"
    )
    return quality.end_to_end(required, evidence(t), log(t))


@query("dq18", f"WITH {GATE_SQL} SELECT * FROM gate")
def dq18(t):
    return gate_rows(t)


@query(
    "dq19",
    """WITH b AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS m, (SELECT MAX(o_orderdate) FROM orders) AS s, o_custkey FROM orders), sv AS (SELECT b.* FROM b JOIN customer ON o_custkey = c_custkey), gd AS (SELECT * FROM sv WHERE m <= 499000),
    f AS (SELECT 'bronze' AS layer, COUNT(*) AS n, SUM(m) AS m, MIN(s) AS lo, MAX(s) AS hi FROM b UNION ALL SELECT 'silver', COUNT(*), SUM(m), MIN(s), MAX(s) FROM sv UNION ALL SELECT 'gold', COUNT(*), SUM(m), MIN(s), MAX(s) FROM gd),
    c AS (SELECT f.layer, f.n = b.n AS rows_ok, f.m = b.m AS money_ok, f.lo = b.lo AND f.hi = b.lo AS snap_ok FROM f, f b WHERE b.layer = 'bronze' AND f.layer <> 'bronze')
    SELECT layer, 'row count agrees' AS check_name, CASE WHEN rows_ok THEN 'PASS' ELSE 'FAIL' END AS status FROM c UNION ALL SELECT layer, 'money agrees', CASE WHEN money_ok THEN 'PASS' ELSE 'FAIL' END FROM c UNION ALL SELECT layer, 'one snapshot', CASE WHEN snap_ok THEN 'PASS' ELSE 'FAIL' END FROM c""",
)
def dq19(t):
    """The second layer is complete, the third lost its largest orders."""
    snap = t.orders.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("snapshot"))
    bronze = t.orders.select(F.col("o_totalprice").cast("decimal(18,2)").alias("money"), "o_custkey").transform(with_context, snap)
    silver = bronze.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("money", "snapshot")
    return quality.cross_layer(
        {"bronze": bronze, "silver": silver, "gold": silver.filter("money <= 499000")}, "money", "snapshot"
    )


@query(
    "dq20",
    f"""WITH {GATE_SQL} SELECT coalesce(layer, 'ALL') AS layer, CAST(SUM(required_checks) AS BIGINT) AS required_checks, CAST(SUM(passed_checks) AS BIGINT) AS passed_checks, CAST(SUM(flagged_checks) AS BIGINT) AS flagged_checks, CAST(SUM(failed_stop_checks) AS BIGINT) AS failed_stop_checks, CAST(SUM(missing_checks) AS BIGINT) AS missing_checks,
        CASE WHEN COUNT(*) FILTER (WHERE status NOT IN ('PASS', 'FLAG')) > 0 THEN 'STOP' WHEN COUNT(*) FILTER (WHERE status = 'FLAG') > 0 THEN 'FLAG' ELSE 'PASS' END AS gate_status, string_agg(CASE WHEN status NOT IN ('PASS', 'FLAG') THEN concat(scope, ': ', details) END, '; ' ORDER BY concat(scope, ': ', details)) AS failure_reason FROM gate GROUP BY GROUPING SETS ((layer), ())""",
)
def dq20(t):
    return quality.summary(gate_rows(t))


@query(
    "dq21",
    f"""WITH {EVIDENCE_SQL} SELECT table_name, check_name, status, action, TRUE AS same_fingerprint FROM (SELECT table_name, check_name, validation_run_id, run_ts, MAX(status) AS status, MAX(action) AS action FROM evidence GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY table_name, check_name ORDER BY run_ts DESC, validation_run_id DESC) = 1""",
)
def dq21(t):
    saved = evidence(t).groupBy("table_name", "check_name", "validation_run_id", "run_ts").agg(
        F.max("status").alias("status"), F.max("action").alias("action")
    )
    newest = quality.acceptance(saved).select("table_name", "check_name", "status", "action")
    marks = [quality.table_mark(f).select(F.struct("*").alias(n)) for f, n in ((evidence(t), "a"), (evidence(t).repartition("table_name"), "b"))]
    same = marks[0].transform(with_context, marks[1]).select((F.col("a") == F.col("b")).alias("same_fingerprint"))
    return newest.transform(with_context, same)


@query(
    "dq22",
    """WITH a AS (SELECT n_regionkey, SUM(CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 END) AS area_total, SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS unresolved_total, COUNT(*) + CASE n_regionkey WHEN 3 THEN 7 ELSE 0 END AS region_total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)
    SELECT n_regionkey AS region_key, CAST(region_total AS BIGINT) AS region_total, CAST(area_total AS BIGINT) AS area_total, CAST(unresolved_total AS BIGINT) AS unresolved_total, CAST(region_total - area_total - unresolved_total AS BIGINT) AS difference, CASE WHEN region_total = area_total + unresolved_total THEN 'RECONCILED' ELSE 'DIFFERENT' END AS reconciliation_status FROM a""",
)
def dq22(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("region_key"), "n_nationkey", "c_mktsegment"
    )
    areas = people.groupBy("region_key", "n_nationkey", (F.col("c_mktsegment") == "BUILDING").alias("open")).agg(F.count(F.lit(1)).alias("n"))
    regions = people.groupBy("region_key").agg(
        (F.count(F.lit(1)) + F.when(F.col("region_key") == 3, 7).otherwise(0)).alias("n")
    )
    return quality.two_level_reconciliation(areas, regions, "region_key", "n", F.col("open"))


@query(
    "dq23",
    f"WITH {W}, x AS ("
    + check_rows("fact", "facts", [
        ("Validity", "class_match_status uses the controlled vocabulary", n_if("class_match_status NOT IN ('MATCHED', 'AMBIGUOUS', 'UNMATCHED')"), "stop"),
        ("Validity", "coordinate_status uses the controlled vocabulary", n_if("coordinate_status NOT IN ('VALID_PAIR', 'MISSING_PAIR')"), "stop"),
        ("Consistency", "a matched class has a level", n_if("class_match_status = 'MATCHED' AND level IS NULL"), "stop"),
        ("Consistency", "no class without a usable point", n_if("coordinate_status <> 'VALID_PAIR' AND class_match_status <> 'UNMATCHED'"), "stop"),
    ])
    + ") SELECT * FROM x",
)
def dq23(t):
    matched = F.col("class_match_status") == "MATCHED"
    return shown(
        checks(star.facts(t), "fact", [
            vocabulary("class_match_status", ["MATCHED", "AMBIGUOUS", "UNMATCHED"]),
            vocabulary("coordinate_status", ["VALID_PAIR", "MISSING_PAIR"]),
            consistent("a matched class has a level", ~matched | F.col("level").isNotNull()),
            consistent("no class without a usable point", (F.col("coordinate_status") == "VALID_PAIR") | (F.col("class_match_status") == "UNMATCHED")),
        ])
    )


@query(
    "dq24",
    f"WITH {W}, g AS (SELECT n_nationkey, COUNT(project_key) AS n, SUM(budget) AS b FROM nation LEFT JOIN facts ON area_key = n_nationkey + 1 GROUP BY 1), x AS ("
    + check_rows("area_mart", "g", [
        ("Accuracy", "money is published where data exists", n_if("n > 0 AND b IS NULL"), "stop"),
        ("Accuracy", "money is NULL where no data exists", n_if("n = 0 AND b IS NOT NULL"), "stop"),
    ])
    + ") SELECT * FROM x",
)
def dq24(t):
    return shown(checks(star.area_members(t), "area_mart", zero_not_null("money", F.col("project_count") > 0, F.col("total_budget"))))
