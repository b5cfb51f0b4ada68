"""The star-schema world on the supplied tables, in Spark and in SQL.

Orders are projects, customers give their place and point, nations are reporting
areas, regions are regions, order years are cohorts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.plans import marts
from verigrid.operators.scale import with_context

CLASSES = {"Low": 1, "Moderate": 2, "High": 3, "Very High": 4}
OTHER_CLASSES = ["AMBIGUOUS", "OUTSIDE_MAPPED_ZONES", "NO_USABLE_POINT", "INVALID_SOURCE"]

PROJECTS_SQL = """
    base AS (SELECT o_orderkey AS project_key, o_orderstatus AS st, o_orderpriority AS pr, CAST(o_orderdate AS DATE) AS od, CAST(o_totalprice AS DECIMAL(18,2)) AS price, c_mktsegment AS seg, c_acctbal AS bal,
        n_nationkey AS n, n_regionkey AS r FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    snap AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS snapshot_date FROM orders),
    keyed AS (SELECT *, CASE WHEN pr = '5-LOW' THEN 0 WHEN pr = '1-URGENT' AND st = 'P' THEN (r + 1) % 5 + 1 ELSE r + 1 END AS region_key,
        CASE WHEN pr IN ('4-NOT SPECIFIED', '5-LOW') OR n IN (7, 24) THEN 0 ELSE n + 1 END AS area_key,
        CASE WHEN n = 18 OR (st = 'P' AND pr = '2-HIGH') THEN NULL ELSE price END AS budget, CASE WHEN pr = '3-MEDIUM' AND st = 'P' THEN NULL ELSE CAST(year(od) AS BIGINT) END AS infra_year,
        CASE WHEN seg = 'BUILDING' AND st = 'P' THEN NULL ELSE st END AS source_status, CASE WHEN seg = 'BUILDING' THEN 'MISSING_PAIR' WHEN seg = 'FURNITURE' THEN 'PARTIAL_PAIR' WHEN bal < 0 THEN 'OUT_OF_RANGE' ELSE 'VALID_PAIR' END AS coordinate_status FROM base),
    projects AS (SELECT *, CASE WHEN region_key = 0 THEN 'NON_GEOGRAPHIC' ELSE 'MATCHED' END AS region_match_status, CASE WHEN pr = '5-LOW' THEN 'NON_GEOGRAPHIC' WHEN area_key = 0 THEN 'UNMAPPED' ELSE 'MATCHED' END AS area_match_status, r + 1 AS area_region_key,
        CASE source_status WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS status_key, CASE source_status WHEN 'F' THEN 'INACTIVE' WHEN 'O' THEN 'ACTIVE' END AS status_group,
        CASE source_status WHEN 'F' THEN 'Completed' WHEN 'O' THEN CASE WHEN pr = '5-LOW' THEN 'For Procurement' ELSE 'On-Going' END END AS standardized_status,
        CASE WHEN coordinate_status <> 'VALID_PAIR' THEN 'UNMATCHED' ELSE CASE pr WHEN '3-MEDIUM' THEN 'AMBIGUOUS' WHEN '4-NOT SPECIFIED' THEN 'UNMATCHED' ELSE 'MATCHED' END END AS class_match_status,
        CASE WHEN coordinate_status = 'VALID_PAIR' THEN CASE pr WHEN '1-URGENT' THEN 'Very High' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low' END END AS level,
        CASE WHEN coordinate_status = 'VALID_PAIR' THEN 5 + bal / 1000 END AS latitude, CASE WHEN coordinate_status = 'VALID_PAIR' THEN 118 + n / 4 END AS longitude,
        CASE seg WHEN 'BUILDING' THEN 'Buildings' WHEN 'MACHINERY' THEN 'Flood Control and Drainage' WHEN 'AUTOMOBILE' THEN 'Roads' WHEN 'FURNITURE' THEN 'Multi-sector' END AS sector,
        CASE seg WHEN 'MACHINERY' THEN TRUE WHEN 'FURNITURE' THEN pr IN ('1-URGENT', '2-HIGH') WHEN 'HOUSEHOLD' THEN NULL ELSE FALSE END AS is_flood, CASE seg WHEN 'HOUSEHOLD' THEN 'UNAPPROVED_SOURCE_CATEGORY' WHEN 'FURNITURE' THEN 'MAPPED_MULTI' ELSE 'MAPPED_SINGLE' END AS sector_status,
        price > 450000 AS in_list, CASE WHEN st = 'F' THEN 100.0 WHEN st = 'O' THEN CASE pr WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN NULL ELSE 45.5 END END AS physical_progress_pct,
        od AS start_date, CASE WHEN n = 9 THEN od - 10 WHEN st = 'F' THEN od + CASE WHEN bal > 3000 THEN 900 ELSE 100 END END AS completion_date FROM keyed),
    facts AS (SELECT *, CASE WHEN class_match_status = 'MATCHED' THEN level WHEN class_match_status = 'UNMATCHED' AND coordinate_status = 'VALID_PAIR' THEN 'OUTSIDE_MAPPED_ZONES' WHEN class_match_status = 'UNMATCHED' THEN 'NO_USABLE_POINT' ELSE class_match_status END AS point_class,
        CASE WHEN completion_date < start_date THEN NULL ELSE start_date + INTERVAL 24 MONTH < least(coalesce(completion_date, snapshot_date), snapshot_date) END AS long_running_flag, physical_progress_pct = 0 AS zero_progress_flag, snapshot_date FROM projects CROSS JOIN snap),
    members AS (SELECT 'REGION' AS level, r_regionkey + 1 AS member_key, r_name AS member_name, r_name = 'MIDDLE EAST' AS is_limited, r_regionkey + 1 AS parent_key FROM region
        UNION ALL SELECT 'REPORTING_AREA', n_nationkey + 1, n_name, r_name = 'MIDDLE EAST', r_regionkey + 1 FROM nation JOIN region ON n_regionkey = r_regionkey),
    population AS (SELECT CASE WHEN c_nationkey = 13 THEN 0 ELSE c_nationkey + 1 END AS area_key, CASE WHEN c_nationkey = 13 THEN 0 ELSE n_regionkey + 1 END AS region_key, y AS reference_year, CAST(COUNT(*) * (1000 + (y - 2020) * 7) AS BIGINT) AS population_count, y <> 2026 AS is_primary_source
        FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (VALUES (2020), (2024), (2026)) v(y) GROUP BY 1, 2, 3),
    area_pop AS (SELECT area_key, reference_year, population_count FROM population WHERE is_primary_source AND area_key <> 0 AND reference_year = 2024),
    region_pop AS (SELECT region_key, reference_year, CAST(SUM(population_count) AS BIGINT) AS population_count FROM population WHERE is_primary_source AND region_key <> 0 AND reference_year = 2024 GROUP BY 1, 2),
    exposure AS (SELECT n_regionkey + 1 AS region_key, CASE WHEN s_acctbal < 2500 THEN 'Low' WHEN s_acctbal < 5000 THEN 'Moderate' WHEN s_acctbal < 7500 THEN 'High' ELSE 'Very High' END AS level, CAST(COUNT(*) * 12.5 AS DECIMAL(18,4)) AS susceptible_area_sqkm,
        MAX(CASE n_regionkey WHEN 1 THEN 'NON_ADDITIVE_CROSS_LEVEL_OVERLAP' WHEN 4 THEN 'NOT_EVALUATED' ELSE 'ADDITIVE_WITHIN_TOLERANCE' END) AS additivity_status FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""


def d2(name):
    return F.col(name).cast("decimal(38,2)").alias(name)


def projects(t):
    """One row per order with every governed field of a project."""
    base = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("project_key"), F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pr"), F.col("o_orderdate").cast("date").alias("od"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("c_mktsegment").alias("seg"),
            F.col("c_acctbal").alias("bal"), F.col("n_nationkey").alias("n"), F.col("n_regionkey").alias("r"),
        )
    )
    pr, st, seg, n, r, bal = (F.col(c) for c in ("pr", "st", "seg", "n", "r", "bal"))
    keyed = base.withColumns(
        {
            "region_key": F.when(pr == "5-LOW", 0)
            .when((pr == "1-URGENT") & (st == "P"), (r + 1) % 5 + 1)
            .otherwise(r + 1),
            "area_key": F.when(pr.isin("4-NOT SPECIFIED", "5-LOW") | n.isin(7, 24), 0).otherwise(n + 1),
            "budget": F.when(~((n == 18) | ((st == "P") & (pr == "2-HIGH"))), F.col("price")),
            "infra_year": F.when(~((pr == "3-MEDIUM") & (st == "P")), F.year("od").cast("bigint")),
            "source_status": F.when(~((seg == "BUILDING") & (st == "P")), st),
            "coordinate_status": F.when(seg == "BUILDING", "MISSING_PAIR")
            .when(seg == "FURNITURE", "PARTIAL_PAIR")
            .when(bal < 0, "OUT_OF_RANGE")
            .otherwise("VALID_PAIR"),
        }
    )
    valid = F.col("coordinate_status") == "VALID_PAIR"
    source = F.col("source_status")
    return keyed.withColumns(
        {
            "region_match_status": F.when(F.col("region_key") == 0, "NON_GEOGRAPHIC").otherwise("MATCHED"),
            "area_match_status": F.when(pr == "5-LOW", "NON_GEOGRAPHIC")
            .when(F.col("area_key") == 0, "UNMAPPED")
            .otherwise("MATCHED"),
            "area_region_key": r + 1,
            "status_key": F.when(source == "F", 1).when(source == "O", 2).when(source == "P", 3).otherwise(0),
            "status_group": F.when(source == "F", "INACTIVE").when(source == "O", "ACTIVE"),
            "standardized_status": F.when(source == "F", "Completed")
            .when((source == "O") & (pr == "5-LOW"), "For Procurement")
            .when(source == "O", "On-Going"),
            "class_match_status": F.when(~valid | (pr == "4-NOT SPECIFIED"), "UNMATCHED")
            .when(pr == "3-MEDIUM", "AMBIGUOUS")
            .otherwise("MATCHED"),
            "level": F.when(
                valid,
                F.when(pr == "1-URGENT", "Very High").when(pr == "2-HIGH", "High").when(pr == "5-LOW", "Low"),
            ),
            "latitude": F.when(valid, 5 + bal / 1000),
            "longitude": F.when(valid, 118 + n / 4),
            "sector": F.when(seg == "BUILDING", "Buildings")
            .when(seg == "MACHINERY", "Flood Control and Drainage")
            .when(seg == "AUTOMOBILE", "Roads")
            .when(seg == "FURNITURE", "Multi-sector"),
            "is_flood": F.when(seg == "MACHINERY", True)
            .when(seg == "FURNITURE", pr.isin("1-URGENT", "2-HIGH"))
            .when(seg != "HOUSEHOLD", False),
            "sector_status": F.when(seg == "HOUSEHOLD", "UNAPPROVED_SOURCE_CATEGORY")
            .when(seg == "FURNITURE", "MAPPED_MULTI")
            .otherwise("MAPPED_SINGLE"),
            "in_list": F.col("price") > 450000,
            "physical_progress_pct": F.when(st == "F", 100.0).when(
                (st == "O") & (pr != "2-HIGH"), F.when(pr == "1-URGENT", 0.0).otherwise(45.5)
            ),
            "start_date": F.col("od"),
            "completion_date": F.when(n == 9, F.date_sub("od", 10)).when(
                st == "F", F.date_add("od", F.when(bal > 3000, 900).otherwise(100))
            ),
        }
    )


def snapshot(t):
    return t.orders.agg(F.max("o_orderdate").cast("date").alias("snapshot_date"))


def facts(t):
    from verigrid.functions.dates import spans_more_than, zero_progress

    dated = projects(t).transform(with_context, snapshot(t))
    return dated.withColumns(
        {
            "point_class": marts.point_class(),
            "long_running_flag": spans_more_than(
                F.col("start_date"), F.col("completion_date"), F.col("snapshot_date"), 24
            ),
            "zero_progress_flag": zero_progress(F.col("physical_progress_pct")),
        }
    )


def members(t):
    regions = t.region.select(
        F.lit("REGION").alias("level"), (F.col("r_regionkey") + 1).alias("member_key"),
        F.col("r_name").alias("member_name"), (F.col("r_name") == "MIDDLE EAST").alias("is_limited"),
        (F.col("r_regionkey") + 1).alias("parent_key"),
    )
    areas = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lit("REPORTING_AREA").alias("level"), (F.col("n_nationkey") + 1).alias("member_key"),
        F.col("n_name").alias("member_name"), (F.col("r_name") == "MIDDLE EAST").alias("is_limited"),
        (F.col("r_regionkey") + 1).alias("parent_key"),
    )
    return regions.unionByName(areas)


def population(t):
    people = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("people"))
    years = people.select("*", F.explode(F.array(F.lit(2020), F.lit(2024), F.lit(2026))).alias("reference_year"))
    placed = years.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    known = F.col("n_nationkey") != 13
    return placed.select(
        F.when(known, F.col("n_nationkey") + 1).otherwise(0).alias("area_key"),
        F.when(known, F.col("n_regionkey") + 1).otherwise(0).alias("region_key"),
        "reference_year",
        (F.col("people") * (1000 + (F.col("reference_year") - 2020) * 7)).alias("population_count"),
        (F.col("reference_year") != 2026).alias("is_primary_source"),
    )


def area_population(t):
    return marts.newest_primary(population(t), "area_key").select("area_key", "reference_year", "population_count")


def region_population(t):
    newest = marts.newest_primary(population(t), "region_key")
    return newest.groupBy("region_key", "reference_year").agg(F.sum("population_count").alias("population_count"))


def exposure(t):
    balance = F.col("s_acctbal")
    level = (
        F.when(balance < 2500, "Low").when(balance < 5000, "Moderate").when(balance < 7500, "High").otherwise("Very High")
    )
    region = F.col("n_regionkey")
    state = (
        F.when(region == 1, "NON_ADDITIVE_CROSS_LEVEL_OVERLAP").when(region == 4, "NOT_EVALUATED").otherwise(
            "ADDITIVE_WITHIN_TOLERANCE"
        )
    )
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy((region + 1).alias("region_key"), level.alias("level"))
        .agg(
            (F.count(F.lit(1)) * F.lit(12.5)).cast("decimal(18,4)").alias("susceptible_area_sqkm"),
            F.max(state).alias("additivity_status"),
        )
    )


def distribution(t):
    return marts.distribution(
        facts(t), members(t), {"REGION": "region_key", "REPORTING_AREA": "area_key"}, "infra_year", "budget"
    )


def area_members(t):
    """Member-level figures of the reporting areas, over all cohorts."""
    by_area = facts(t).filter("area_key <> 0").groupBy(F.col("area_key").alias("member_key")).agg(
        *marts.count_money("budget")
    )
    areas = members(t).filter("level = 'REPORTING_AREA'")
    joined = areas.join(by_area, "member_key", "left")
    return joined.withColumns(
        {
            "project_count": F.coalesce("project_count", F.lit(0)),
            "coverage": marts.coverage_status(F.col("project_count"), F.col("is_limited")),
        }
    )


def region_members(t):
    return members(t).filter("level = 'REGION'").select(
        F.col("member_key").alias("region_key"), F.col("member_name").alias("region_name"), "is_limited"
    )


def classes(t):
    rows = [(name, True, rank) for name, rank in CLASSES.items()] + [(n, False, None) for n in OTHER_CLASSES]
    return t.spark.createDataFrame(rows, "point_class string, is_level boolean, severity_rank int")


#: What a project can be joined to, by the column that shows it: a member key with the column that tells
#: the outcome, a value reached through a key, a status with its good value, an amount, a mark or a group.
LINKS = [
    marts.Link("budget", "amount"),
    marts.Link("in_list", "mark"),
    marts.Link("coordinate_status", "status", "VALID_PAIR"),
    marts.Link("hierarchy_status", "status", "CONSISTENT"),
    marts.Link("class_match_status", "status", "MATCHED"),
    marts.Link("region_key", "member", "region_match_status"),
    marts.Link("area_key", "member", "area_match_status"),
    marts.Link("region_population", "value", "region_key"),
    marts.Link("area_population", "value", "area_key"),
    marts.Link("sector", "group", "sector_status"),
    marts.Link("status_group", "group", "status_mapping_status"),
]
