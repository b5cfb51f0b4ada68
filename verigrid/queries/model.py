"""Dimensions, facts, entity consolidation and hierarchy on the supplied tables (DIM*, FCT*, MAT*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.functions import identity, typing
from verigrid.functions.dates import date_key
from verigrid.operators import mapping as maps
from verigrid.operators import matching, resolve, scale
from verigrid.plans import model
from verigrid.queries import mapping as mapping_queries
from verigrid.queries import star
from verigrid.queries.mapping import PART_TOKENS_SQL, RULES_SQL, acting_statuses, acting_tokens, part_tokens
from verigrid.queries.registry import query
from verigrid.queries.star import PROJECTS_SQL as W, d2
from verigrid.operators.scale import with_context

PLACES_SQL = """
    codes AS (SELECT concat(lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0'), '00000000') AS code, r_name AS name, 'REGION' AS place_type FROM region WHERE r_name <> 'EUROPE'
        UNION ALL SELECT concat(lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0'), '00000'), n_name, CASE WHEN n_nationkey >= 20 THEN 'CITY' WHEN n_nationkey = 11 THEN 'UNASSIGNED' ELSE 'PROVINCE' END FROM nation
        UNION ALL SELECT concat(lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0'), lpad(CAST(seg AS VARCHAR), 2, '0'), '000'), concat(n_name, ' ', c_mktsegment), 'MUNICIPALITY'
            FROM (SELECT DISTINCT c_nationkey, c_mktsegment, length(c_mktsegment) AS seg FROM customer WHERE c_mktsegment <> 'MACHINERY') JOIN nation ON n_nationkey = c_nationkey
        UNION ALL SELECT concat(lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0'), lpad(CAST(length(c_mktsegment) AS VARCHAR), 2, '0'), lpad(CAST(c_custkey % 999 + 1 AS VARCHAR), 3, '0')), c_name, 'BARANGAY' FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


def places(t):
    """Regions, provinces or cities, segments of a nation as municipalities, customers as leaves."""
    pad = lambda col, width: F.lpad(col.cast("string"), width, "0")
    nation_part = F.concat(pad(F.col("n_regionkey") + 1, 2), pad(F.col("n_nationkey") + 1, 3))
    segment_part = pad(F.length("c_mktsegment"), 2)
    number = F.col("c_custkey") % 999 + 1
    regions = t.region.filter("r_name <> 'EUROPE'").select(
        F.concat(pad(F.col("r_regionkey") + 1, 2), F.lit("00000000")).alias("code"),
        F.col("r_name").alias("name"), F.lit("REGION").alias("place_type"),
    )
    kind = (
        F.when(F.col("n_nationkey") >= 20, "CITY").when(F.col("n_nationkey") == 11, "UNASSIGNED").otherwise("PROVINCE")
    )
    nations = t.nation.select(
        F.concat(nation_part, F.lit("00000")).alias("code"), F.col("n_name").alias("name"), kind.alias("place_type")
    )
    towns = (
        t.customer.filter("c_mktsegment <> 'MACHINERY'").select("c_nationkey", "c_mktsegment").distinct()
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(nation_part, segment_part, F.lit("000")).alias("code"),
            F.concat("n_name", F.lit(" "), "c_mktsegment").alias("name"), F.lit("MUNICIPALITY").alias("place_type"),
        )
    )
    leaves = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(nation_part, segment_part, pad(number, 3)).alias("code"),
        F.col("c_name").alias("name"), F.lit("BARANGAY").alias("place_type"),
    )
    return regions.unionByName(nations).unionByName(towns).unionByName(leaves)


HIERARCHY_SQL = f"""{PLACES_SQL}, h AS (SELECT c.*, r.code AS region_code, r.name AS region_name, p.code AS province_code, p.name AS province_name, l.code AS locality_code, l.name AS locality_name FROM codes c
    LEFT JOIN codes r ON r.place_type = 'REGION' AND r.code = concat(substr(c.code, 1, 2), '00000000') LEFT JOIN codes p ON p.place_type = 'PROVINCE' AND p.code = concat(substr(c.code, 1, 5), '00000')
    LEFT JOIN codes l ON l.place_type IN ('CITY', 'MUNICIPALITY') AND l.code = concat(substr(c.code, 1, 7), '000'))"""


def hierarchy(t):
    return matching.code_hierarchy(
        places(t),
        {"region": (2, ["REGION"]), "province": (5, ["PROVINCE"]), "locality": (7, ["CITY", "MUNICIPALITY"])},
        10,
    )


@query(
    "mat01",
    f"""WITH {HIERARCHY_SQL} SELECT *, CASE WHEN place_type = 'UNASSIGNED' THEN 'UNASSIGNED_GEOGRAPHIC_LEVEL' WHEN place_type <> 'REGION' AND region_code IS NULL THEN 'MISSING_VERIFIED_REGION' WHEN place_type = 'BARANGAY' AND locality_code IS NULL THEN 'MISSING_VERIFIED_LOCALITY' ELSE 'VALID_HIERARCHY' END AS hierarchy_status FROM h""",
)
def mat01(t):
    return hierarchy(t).withColumn("hierarchy_status", matching.hierarchy_status("REGION", "BARANGAY"))


AREAS_SQL = f"""{HIERARCHY_SQL},
    areas AS (SELECT code, name, 'PROVINCE' AS area_type, region_code AS parent_code, TRUE AS is_geographic_area FROM h WHERE place_type = 'PROVINCE'
        UNION ALL SELECT code, name, 'INDEPENDENT_CITY', region_code, TRUE FROM h WHERE place_type = 'CITY' AND province_code IS NULL AND region_code <> '0100000000'
        UNION ALL SELECT code, name, 'NCR', code, TRUE FROM h WHERE code = '0100000000' UNION ALL SELECT NULL, 'Unknown or unmapped', 'UNKNOWN', NULL, FALSE)"""


def areas(t):
    """Provinces, cities outside the capital region without a province, and the capital region."""
    tree = hierarchy(t)
    capital = "0100000000"
    parent = F.col("region_code").alias("parent_code")
    return matching.reporting_areas(
        {
            "PROVINCE": tree.filter("place_type = 'PROVINCE'").select("code", "name", parent),
            "INDEPENDENT_CITY": tree.filter("place_type = 'CITY' and province_code is null")
            .filter(F.col("region_code") != capital)
            .select("code", "name", parent),
            "NCR": tree.filter(F.col("code") == capital).select("code", "name", F.col("code").alias("parent_code")),
        }
    )


@query("mat02", f"WITH {AREAS_SQL} SELECT * FROM areas")
def mat02(t):
    return areas(t)


@query(
    "mat10",
    """
    WITH s AS (SELECT upper(trim(concat('C-', CAST(s_nationkey AS VARCHAR), '-', CAST(CAST(floor(s_acctbal / 100) AS BIGINT) AS VARCHAR)))) AS match_key, COUNT(*) AS n FROM supplier GROUP BY 1),
    c AS (SELECT upper(trim(concat(' c-', CAST(c_nationkey AS VARCHAR), '-', CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR)))) AS match_key, COUNT(*) AS n, MAX(c_custkey) AS id FROM customer GROUP BY 1)
    SELECT s.match_key, CAST(s.n AS BIGINT) AS source_rows, CAST(coalesce(c.n, 0) AS BIGINT) AS target_candidate_count, CASE coalesce(c.n, 0) WHEN 1 THEN 'MATCHED' WHEN 0 THEN 'UNMATCHED' ELSE 'AMBIGUOUS_TARGET' END AS match_status, CASE WHEN c.n = 1 THEN id END AS matched_id FROM s LEFT JOIN c ON c.match_key = s.match_key""",
)
def mat10(t):
    def key(prefix, nation, balance):
        return F.upper(
            F.trim(F.concat(F.lit(prefix), F.col(nation).cast("string"), F.lit("-"), F.floor(F.col(balance) / 100).cast("string")))
        )

    return matching.exact_match(
        t.supplier, t.customer, key("C-", "s_nationkey", "s_acctbal"), key(" c-", "c_nationkey", "c_acctbal"), "c_custkey"
    )


@query(
    "mat14",
    """
    WITH seen AS (SELECT DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey + 5 ELSE c_nationkey END AS code FROM customer), m AS (SELECT n_nationkey AS code FROM nation), pub AS (SELECT DISTINCT s_nationkey AS code FROM supplier WHERE s_acctbal > 5000)
    SELECT 'OBSERVED_CODE_NOT_A_MEMBER' AS gap, CAST(COUNT(*) AS BIGINT) AS codes FROM seen WHERE code NOT IN (SELECT code FROM m) UNION ALL SELECT 'MEMBER_WITHOUT_OBSERVATION', COUNT(*) FROM m WHERE code NOT IN (SELECT code FROM seen)
    UNION ALL SELECT 'MEMBER_WITHOUT_PUBLICATION', COUNT(*) FROM m WHERE code NOT IN (SELECT code FROM pub)""",
)
def mat14(t):
    moved = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") + 5).otherwise(F.col("c_nationkey"))
    return matching.contract_gaps(
        t.customer.select(moved.alias("code")), t.nation.select(F.col("n_nationkey").alias("code")),
        t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("code")),
    )


def raw_components(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("contract_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("budget_raw"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"))).otherwise("").alias("progress_raw"),
        F.col("l_partkey").cast("string").alias("part_raw"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("start_raw"),
    )


def typed_components(raw):
    """Typed values and their statuses beside the raw texts."""
    budget, budget_status = typing.typed(F.col("budget_raw"), "decimal(18,2)", 0, below="NEGATIVE")
    progress, progress_status = typing.typed(F.col("progress_raw"), "double", 0, 40)
    return raw.withColumns(
        {
            "budget": budget, "budget_quality_status": budget_status,
            "progress": progress, "progress_quality_status": progress_status,
            "start_date": F.col("start_raw").try_cast("date"),
        }
    )


def components(t):
    """Every line as a component with one key per source row; equal rows are numbered."""
    raw = raw_components(t)
    numbered = scale.identical_row_ordinals(raw, "source_row_ordinal")
    keyed = numbered.withColumn("source_row_hash", identity.row_hash(raw.columns))
    key = identity.run_id("COMPONENT", "snap-1", F.col("source_row_hash"), F.col("source_row_ordinal"))
    return typed_components(keyed.withColumn("component_key", key))


COMPONENT_SQL = """
    raw AS (SELECT CAST(l_orderkey AS VARCHAR) AS contract_id, CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS budget_raw, CASE WHEN l_linestatus = 'O' THEN concat(' ', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) ELSE '' END AS progress_raw,
        CAST(l_partkey AS VARCHAR) AS part_raw, strftime(l_shipdate, '%Y-%m-%d') AS start_raw FROM lineitem),
    hashed AS (SELECT *, sha256(concat('{"contract_id":"', contract_id, '",', CASE WHEN budget_raw IS NULL THEN '' ELSE concat('"budget_raw":"', budget_raw, '",') END, '"progress_raw":"', progress_raw, '","part_raw":"', part_raw, '","start_raw":"', start_raw, '"}')) AS source_row_hash FROM raw),
    comp AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY source_row_hash ORDER BY source_row_hash) AS BIGINT) AS source_row_ordinal, TRY_CAST(budget_raw AS DECIMAL(18,2)) AS budget, CASE WHEN budget_raw IS NULL THEN 'MISSING' ELSE 'VALID' END AS budget_quality_status,
        TRY_CAST(NULLIF(trim(progress_raw), '') AS DOUBLE) AS progress, CASE WHEN trim(progress_raw) = '' THEN 'MISSING' WHEN CAST(trim(progress_raw) AS DOUBLE) > 40 THEN 'OUT_OF_RANGE' ELSE 'VALID' END AS progress_quality_status FROM hashed)"""


@query(
    "mat16",
    f"""WITH {COMPONENT_SQL} SELECT sha256(concat_ws('|', 'COMPONENT', 'snap-1', source_row_hash, CAST(source_row_ordinal AS VARCHAR))) AS component_key, contract_id, source_row_ordinal, budget_raw, budget, budget_quality_status, progress, progress_quality_status, start_raw AS start_date FROM comp""",
)
def mat16(t):
    return components(t).select(
        "component_key", "contract_id", "source_row_ordinal", "budget_raw", "budget", "budget_quality_status",
        "progress", "progress_quality_status", F.col("start_date").cast("string").alias("start_date"),
    )


@query(
    "mat17",
    f"""WITH {COMPONENT_SQL}, g AS (SELECT contract_id, COUNT(*) AS n, COUNT(DISTINCT part_raw) AS dp, MAX(part_raw) AS p, COUNT(DISTINCT start_raw) AS ds, MAX(start_raw) AS s, COUNT(DISTINCT progress) AS dg, MAX(progress) AS pg, COUNT(DISTINCT budget) AS db, COUNT(budget) AS vb, MAX(budget) AS b FROM comp GROUP BY 1)
    SELECT sha256(concat_ws('|', 'PROJECT', contract_id)) AS project_key, contract_id, CAST(n AS BIGINT) AS component_count, CASE WHEN dp = 1 THEN p END AS part, CASE dp WHEN 0 THEN 'MISSING' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS part_resolution_status, CASE WHEN ds = 1 THEN s END AS start_date, CASE ds WHEN 0 THEN 'MISSING_OR_INVALID' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS start_date_resolution_status,
      CASE WHEN dg = 1 THEN pg END AS progress, CASE dg WHEN 0 THEN 'MISSING_OR_INVALID' WHEN 1 THEN 'RESOLVED' ELSE 'CONFLICT' END AS progress_resolution_status, CASE WHEN dg = 1 THEN pg = 0 END AS zero_progress_flag, CASE WHEN db = 1 THEN b END AS budget, CASE WHEN db = 0 THEN 'MISSING_OR_INVALID' WHEN db = 1 AND vb = 1 THEN 'RESOLVED_SINGLE' WHEN db = 1 THEN 'RESOLVED_REPEATED_IDENTICAL' ELSE 'CONFLICT' END AS budget_resolution_status FROM g""",
)
def mat17(t):
    invalid = "MISSING_OR_INVALID"
    # consolidation needs the rows, not their keys
    entity = resolve.resolve_attributes(
        typed_components(raw_components(t)), ["contract_id"],
        {
            "part": typing.blank_to_null(F.col("part_raw")), "start_date": F.col("start_date"),
            "progress": F.col("progress"),
        },
        money={"budget": F.col("budget")},
        missing={"start_date": invalid, "progress": invalid, "budget": invalid},
    )
    return entity.select(
        identity.run_id("PROJECT", F.col("contract_id")).alias("project_key"), "contract_id", "component_count",
        "part", "part_resolution_status", F.col("start_date").cast("string").alias("start_date"),
        "start_date_resolution_status", "progress", "progress_resolution_status",
        F.when(F.col("progress_resolution_status") == "RESOLVED", F.col("progress") == 0).alias("zero_progress_flag"),
        "budget", "budget_resolution_status",
    )


@query(
    "dim01",
    """
    WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi FROM orders, (SELECT MAX(l_shipdate) AS l_shipdate FROM lineitem)),
    d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key, CAST(day AS VARCHAR) AS calendar_date, CAST(year(day) AS BIGINT) AS year, CAST(quarter(day) AS BIGINT) AS quarter, CAST(month(day) AS BIGINT) AS month, strftime(day, '%B') AS month_name, CAST(day(day) AS BIGINT) AS day_of_month, strftime(day, '%Y-%m') AS year_month FROM d
    UNION ALL SELECT 0, NULL, NULL, NULL, NULL, 'Unknown', NULL, 'Unknown'""",
)
def dim01(t):
    return calendar(t).withColumn("calendar_date", F.col("calendar_date").cast("string"))


def calendar(t):
    last = t.lineitem.agg(F.max("l_shipdate").cast("date").alias("hi"))
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo")).transform(with_context, last)
    return model.calendar(t.spark, F.col("lo"), F.col("hi"), bounds)


def region_dim(t):
    members = t.region.select(
        F.concat(F.lit("R"), (F.col("r_regionkey") + 1).cast("string")).alias("region_code"),
        F.col("r_name").alias("region_name"),
    )
    return model.dimension(members, "region_key", "REGION", ["region_code"], {"region_name": "Unknown"})


@query(
    "dim02",
    """SELECT concat('R', CAST(r_regionkey + 1 AS VARCHAR)) AS region_code, r_name AS region_name, FALSE AS is_unknown, TRUE AS has_unique_key, (SELECT CAST(COUNT(*) AS BIGINT) FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = r_regionkey) AS customers FROM region UNION ALL SELECT NULL, 'Unknown', TRUE, TRUE, 0""",
)
def dim02(t):
    counted = scale.attach_group_values(region_dim(t), ["region_key"], {"n": F.count(F.lit(1))})
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.concat(F.lit("R"), (F.col("n_regionkey") + 1).cast("string")).alias("region_code")
    ).agg(F.count(F.lit(1)).alias("customers"))
    return counted.join(people, "region_code", "left").select(
        "region_code", "region_name", (F.col("region_key") == 0).alias("is_unknown"), (F.col("n") == 1).alias("has_unique_key"),
        F.coalesce("customers", F.lit(0)).alias("customers"),
    )


@query(
    "dim03",
    """WITH b AS (SELECT concat('N', CAST(s_nationkey AS VARCHAR)) AS code, CASE WHEN s_acctbal < 7000 THEN 'b1' ELSE 'b2' END AS boundary_version, s_nationkey AS x, 1 + s_suppkey % 7 AS w FROM supplier),
    g AS (SELECT code, boundary_version, CAST(COUNT(*) AS BIGINT) AS feature_count, MAX(x) AS x, MAX(w) AS w FROM b WHERE code <> 'N13' GROUP BY 1, 2),
    total AS (SELECT COUNT(*) FILTER (WHERE code = 'N13') AS lost FROM b)
    SELECT code, boundary_version, feature_count, CASE WHEN feature_count = 1 THEN 'PUBLISHED' ELSE 'SKIPPED_AMBIGUOUS' END AS publication_status, feature_count = 1 AS has_key, CASE WHEN feature_count = 1 THEN TRUE END AS geometry_valid_flag,
        CASE WHEN feature_count = 1 THEN ROUND(CAST(x AS DOUBLE) + w / 3.0, 6) END AS centroid_longitude, CASE WHEN feature_count = 1 THEN ROUND(10 + 2 / 3.0::DOUBLE, 6) END AS centroid_latitude, CAST(lost AS BIGINT) AS skipped_no_member FROM g, total""",
)
def dim03(t):
    """A right-angled triangle per supplier is a shape of its nation; nation 13 is no member."""
    code = lambda c: F.concat(F.lit("N"), F.col(c).cast("string")).alias("code")
    members = t.nation.filter("n_nationkey <> 13").select(F.col("n_nationkey").alias("key"), code("n_nationkey"))
    x, width, low = F.col("s_nationkey").cast("double"), (1 + F.col("s_suppkey") % 7).cast("double"), F.lit(10.0)
    corners = F.array(F.array(x, low), F.array(x + width, low), F.array(x, low + 2), F.array(x, low))
    boundaries = t.supplier.select(
        code("s_nationkey"), F.when(F.col("s_acctbal") < 7000, "b1").otherwise("b2").alias("boundary_version"),
        F.array(corners).alias("rings"),
    )
    made = model.boundary_dimension(members, boundaries, "key")
    losses = model.boundary_losses(made, boundaries).select("skipped_no_member")
    return made.transform(with_context, losses).select(
        "code", "boundary_version", "feature_count", "publication_status", F.col("boundary_key").isNotNull().alias("has_key"),
        "geometry_valid_flag", F.round("centroid_longitude", 6).alias("centroid_longitude"),
        F.round("centroid_latitude", 6).alias("centroid_latitude"), "skipped_no_member",
    )


@query(
    "dim04",
    """SELECT DISTINCT substr(o_orderpriority, 3) AS level, CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS BIGINT) AS severity_rank, FALSE AS is_unknown FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' UNION ALL SELECT 'Unknown', NULL, TRUE""",
)
def dim04(t):
    levels = t.orders.filter("o_orderpriority <> '4-NOT SPECIFIED'").select(
        F.expr("substring(o_orderpriority, 3)").alias("level"),
        (6 - F.substring("o_orderpriority", 1, 1).cast("int")).cast("bigint").alias("severity_rank"),
    ).distinct()
    made = model.dimension(levels, "level_key", "LEVEL", ["level"], {"level": "Unknown"})
    return made.select("level", "severity_rank", (F.col("level_key") == 0).alias("is_unknown"))


@query(
    "dim05",
    f"""WITH {RULES_SQL}, obs AS (SELECT DISTINCT o_orderstatus AS s FROM orders UNION SELECT DISTINCT upper(event_type) FROM events),
    m AS (SELECT source_status, version, standardized_status, status_group FROM status_rules WHERE approval_status = 'APPROVED')
    SELECT source_status, version, standardized_status, status_group, version = 's3' AS is_active FROM m UNION ALL SELECT s, 's3', NULL, NULL, TRUE FROM obs WHERE s NOT IN (SELECT source_status FROM m WHERE version = 's3') UNION ALL SELECT NULL, NULL, NULL, NULL, NULL""",
)
def dim05(t):
    return status_dim(t).drop("status_key")


def status_dim(t):
    observed = t.orders.select(F.col("o_orderstatus").alias("source_status")).distinct().union(
        t.events.select(F.upper("event_type")).distinct()
    )
    approved = mapping_queries.status_rules(t).filter("approval_status = 'APPROVED'")
    return model.status_dimension(observed, approved, "s3")


@query(
    "dim06",
    """SELECT o_orderkey, o_orderpriority, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity = 50) AS is_in_official_list FROM orders""",
)
def dim06(t):
    listed = t.lineitem.filter("l_returnflag = 'R' and l_quantity = 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return model.project_dimension(t.orders.select("o_orderkey", "o_orderpriority"), listed, "o_orderkey")


@query(
    "dim07",
    f"""WITH {AREAS_SQL}, b AS (SELECT concat(lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0'), '00000') AS code, COUNT(*) AS n, COUNT(*) FILTER (WHERE s_acctbal > 2000) AS ok FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
    SELECT areas.code, name, area_type, parent_code, CASE WHEN area_type = 'UNKNOWN' THEN 'NOT_APPLICABLE' WHEN coalesce(n, 0) = 0 THEN 'MISSING_BOUNDARY' WHEN n > 1 THEN 'AMBIGUOUS_BOUNDARY' WHEN ok = 0 THEN 'INVALID_BOUNDARY' ELSE 'VALID_BOUNDARY' END AS boundary_status FROM areas LEFT JOIN b ON b.code = areas.code""",
)
def dim07(t):
    from verigrid.operators.spatial import boundary_status

    code = F.concat(
        F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"), F.lit("00000")
    )
    boundaries = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        code.alias("code"), (F.col("s_acctbal") > 2000).alias("is_valid")
    )
    return boundary_status(areas(t), boundaries).select("code", "name", "area_type", "parent_code", "boundary_status")


FACT_OUT = """SELECT project_key AS contract_id, CASE WHEN region_match_status = 'MATCHED' THEN concat('R', CAST(region_key AS VARCHAR)) END AS region_code, CASE WHEN region_match_status = 'MATCHED' THEN CASE WHEN start_date < DATE '1994-01-01' + CAST(region_key AS INTEGER) * 90 THEN 'g1' WHEN start_date < DATE '1996-06-01' THEN 'g2' ELSE 'g3' END END AS region_version,
        CASE WHEN area_match_status = 'MATCHED' THEN concat('N', CAST(area_key AS VARCHAR)) END AS area_code, source_status, status_group, CASE WHEN class_match_status = 'MATCHED' AND level IN (SELECT level FROM exposure) THEN level END AS level,
        CAST(strftime(snapshot_date, '%Y%m%d') AS BIGINT) AS snapshot_date_key, CAST(strftime(start_date, '%Y%m%d') AS BIGINT) AS start_date_key, coalesce(CAST(strftime(completion_date, '%Y%m%d') AS BIGINT), 0) AS completion_date_key, budget, long_running_flag, zero_progress_flag,
        concat('ORDERS-', strftime(snapshot_date, '%Y%m%d')) AS source_snapshot_id, sha256(concat('ORDERS-', strftime(snapshot_date, '%Y%m%d'), '|s3|delivery-1')) AS run_id FROM facts"""


def region_versions(t):
    """Each region in three versions; the first border differs by region, the outer ones are open."""
    number = F.col("r_regionkey") + 1
    first_border = F.date_add(F.lit("1994-01-01").cast("date"), (number * 90).cast("int"))
    second_border, none = F.lit("1996-06-01").cast("date"), F.lit(None).cast("date")
    spans = F.array(
        *[
            F.struct(F.lit(name).alias("version"), since.alias("valid_from"), until.alias("valid_until"))
            for name, since, until in (
                ("g1", none, first_border), ("g2", first_border, second_border), ("g3", second_border, none)
            )
        ]
    )
    members = t.region.select(F.concat(F.lit("R"), number.cast("string")).alias("region_code"), F.inline(spans))
    return model.dimension(members, "region_key", "REGION", ["region_code", "version"], {})


def snapshot_fact(t):
    """Projects with their keys resolved against the real dimensions."""
    code = lambda letter, key: F.when(F.col(key) != 0, F.concat(F.lit(letter), F.col(key).cast("string")))
    rows = star.projects(t).withColumns({"region_natural": code("R", "region_key"), "area_natural": code("N", "area_key")})
    rows = rows.drop("region_key", "area_key", "status_key", "status_group")
    areas = t.nation.select(F.concat(F.lit("N"), (F.col("n_nationkey") + 1).cast("string")).alias("area_code"))
    levels = star.exposure(t).select("level").distinct()
    rules = {
        "region_key": model.KeyRule(
            region_versions(t), "region_key", {"region_natural": "region_code"},
            F.col("region_match_status").isin("MATCHED", "MATCHED_WITH_CONFLICT"),
            ("valid_from", "valid_until"), "start_date", {"region_code": "region_code", "version": "region_version"},
        ),
        "area_key": model.KeyRule(
            model.dimension(areas, "area_key", "AREA", ["area_code"], {}), "area_key", {"area_natural": "area_code"},
            F.col("area_match_status") == "MATCHED", carry={"area_code": "area_code"},
        ),
        "status_key": model.KeyRule(
            status_dim(t).filter("is_active"), "status_key", {"source_status": "source_status"},
            carry={"status_group": "status_group"}, stop=True,
        ),
        "level_key": model.KeyRule(
            model.dimension(levels, "level_key", "LEVEL", ["level"], {}), "level_key", {"level": "level"},
            F.col("class_match_status") == "MATCHED", carry={"level": "mapped_level"},
        ),
    }
    return model.snapshot_fact(rows, rules, star.snapshot(t), "ORDERS", ["s3", "delivery-1"])


@query("fct01", f"WITH {W} {FACT_OUT}")
def fct01(t):
    return snapshot_fact(t).select(
        "contract_id", "region_code", "region_version", "area_code", "source_status", "status_group",
        F.col("mapped_level").alias("level"), "snapshot_date_key", "start_date_key", "completion_date_key", "budget",
        "long_running_flag", "zero_progress_flag", "source_snapshot_id", "run_id",
    )


@query(
    "fct02",
    f"""WITH {W} SELECT CASE WHEN region_key <> 0 THEN concat('R', CAST(region_key AS VARCHAR)) END AS region_code, reference_year, is_primary_source, CAST(SUM(population_count) AS BIGINT) AS population_count FROM population GROUP BY ALL""",
)
def fct02(t):
    people = star.population(t).withColumn(
        "region_code", F.when(F.col("region_key") != 0, F.concat(F.lit("R"), F.col("region_key").cast("string")))
    )
    totals = people.groupBy("region_code", "reference_year", "is_primary_source").agg(
        F.sum("population_count").alias("population_count")
    )
    fact = model.population_fact(totals, region_dim(t).filter("region_key <> 0"), "region_code", "region_key")
    back = region_dim(t).select("region_key", F.col("region_code").alias("dim_code"))
    return fact.join(back, "region_key").select(
        F.col("dim_code").alias("region_code"), "reference_year", "is_primary_source", "population_count"
    )


@query(
    "fct03",
    f"""WITH {W} SELECT CASE WHEN area_key = 0 THEN 'Unknown' ELSE concat('NATION_', CAST(area_key - 1 AS VARCHAR)) END AS area_name, reference_year, is_primary_source, CAST(SUM(population_count) AS BIGINT) AS population_count FROM population GROUP BY ALL""",
)
def fct03(t):
    area = model.dimension(t.nation.select(F.col("n_name").alias("area_name")), "key", "AREA", ["area_name"], {"area_name": "Unknown"})
    people = star.population(t).withColumn(
        "area_name", F.when(F.col("area_key") != 0, F.concat(F.lit("NATION_"), (F.col("area_key") - 1).cast("string")))
    ).select("area_name", "reference_year", "is_primary_source", "population_count")
    fact = model.population_fact(people, area.filter("key <> 0"), "area_name", "key").drop("area_name")
    return fact.join(area, "key").groupBy("area_name", "reference_year", "is_primary_source").agg(
        F.sum("population_count").alias("population_count")
    )


@query(
    "fct04",
    f"""WITH {W} SELECT concat('R', CAST(region_key AS VARCHAR)) AS region_code, CASE WHEN level = 'Low' THEN NULL ELSE level END AS level, susceptible_area_sqkm, additivity_status FROM exposure""",
)
def fct04(t):
    """The level Low has no dimension member here, so its rows go to key 0."""
    grid = star.exposure(t).withColumn("region_code", F.concat(F.lit("R"), F.col("region_key").cast("string"))).drop("region_key")
    levels = model.dimension(grid.filter("level <> 'Low'").select("level").distinct(), "level_key", "LEVEL", ["level"], {})
    fact = model.exposure_fact(grid, region_dim(t), levels).drop("region_code", "level")
    return fact.join(region_dim(t), "region_key").join(levels, "level_key").select(
        "region_code", "level", "susceptible_area_sqkm", "additivity_status"
    )


@query(
    "fct05",
    f"""WITH {W}, cal AS (SELECT MAX(CAST(l_shipdate AS DATE)) AS hi, (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AS lo FROM lineitem),
    used AS (SELECT start_date AS d FROM facts UNION ALL SELECT completion_date FROM facts) SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(COUNT(*) AS BIGINT) AS rows FROM used, cal WHERE d IS NOT NULL AND (d > hi OR d < lo) GROUP BY 1""",
)
def fct05(t):
    fact = star.projects(t).select(
        date_key(F.col("start_date")).alias("start_date_key"), date_key(F.col("completion_date")).alias("completion_date_key")
    )
    return model.orphan_dates(fact, ["start_date_key", "completion_date_key"], calendar(t))


@query(
    "fct06",
    f"""WITH {W} SELECT CAST(COUNT(*) AS BIGINT) AS projects, CAST(COUNT(*) FILTER (WHERE long_running_flag) AS BIGINT) AS long_running, CAST(COUNT(*) FILTER (WHERE long_running_flag IS NULL) AS BIGINT) AS not_judged, CAST(COUNT(*) FILTER (WHERE zero_progress_flag) AS BIGINT) AS zero_progress, CAST(COUNT(*) FILTER (WHERE zero_progress_flag IS NULL) AS BIGINT) AS unresolved_progress, TRUE AS is_reconciled FROM facts""",
)
def fct06(t):
    counts = {
        "long_running": F.count_if("long_running_flag"),
        "not_judged": F.count_if(F.col("long_running_flag").isNull()),
        "zero_progress": F.count_if("zero_progress_flag"),
        "unresolved_progress": F.count_if(F.col("zero_progress_flag").isNull()),
    }
    keys = ["project_key", "region_key", "area_key", "status_key", "level_key", "snapshot_date_key", "start_date_key"]
    checked = model.fact_checks(
        snapshot_fact(t), star.projects(t), keys, "budget", "project_snapshot_key", counts
    )
    return checked.select(F.col("fact_rows").alias("projects"), *counts, "is_reconciled")


@query(
    "fct07",
    """SELECT o_orderpriority AS table_name, concat('snap-', CAST(o_orderkey AS VARCHAR)) AS snapshot_id, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS snapshot_date FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' QUALIFY ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, concat('run-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) DESC) = 1""",
)
def fct07(t):
    lineage = model.snapshot_lineage(load_log(t), "2-HIGH")
    return lineage.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def load_log(t):
    """Orders as load events: the priority is the table, the status says how the load ended."""
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.concat(F.lit("run-"), F.lpad(key, 12, "0")).alias("run_id"), F.col("o_orderpriority").alias("table_name"),
        F.concat(F.lit("snap-"), key).alias("snapshot_id"),
        F.when(status == "F", "SUCCESS").when(status == "O", "SKIPPED_IDEMPOTENT").otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("completed_at"), F.col("o_orderdate").alias("started_at"),
        F.date_sub("o_orderdate", 1).alias("source_modified_at"),
        F.floor("o_totalprice").alias("rows_loaded"),
    )
