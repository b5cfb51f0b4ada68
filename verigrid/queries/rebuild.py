"""The five marts once more, from orders, customers and nations alone (DQ14).

Nothing here uses the fact, the dimensions or the mart builders: what a mart says about a project is told
by the source columns directly, so a fault in any layer between makes the two sides differ.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.operators.windows import pct, per_unit
from verigrid.sinks.stage import materialize

WITHHELD = "n = 18 OR (st = 'P' AND pr = '2-HIGH')"
NO_AREA = "pr IN ('4-NOT SPECIFIED', '5-LOW') OR n IN (7, 24)"
POINT = "seg NOT IN ('BUILDING', 'FURNITURE') AND coalesce(bal >= 0, TRUE)"
MOVED = "pr = '1-URGENT' AND st = 'P'"

#: Column families of each mart; a family that differs is one failed check.
FAMILIES = {
    "distribution_mart": {
        "counts": ["project_count", "projects_with_budget", "member_project_count"],
        "money": ["total_budget", "member_budget"],
    },
    "equity_mart": {
        "counts": ["project_count", "population_count"],
        "money": ["total_budget"],
        "status": ["coverage", "equity_status"],
        "shares": ["population_share_pct", "investment_share_pct"],
        "rates": ["investment_per_capita", "per_capita_rank"],
    },
    "alignment_mart": {
        "counts": ["project_count", "flood_count", "listed_count"],
        "money": ["total_budget", "flood_budget", "listed_budget"],
    },
    "monitoring_mart": {
        "reasons": [
            "review_active_zero_progress", "review_active_long_running", "review_active_progress_not_published",
            "review_inactive_status", "review_unresolved_status",
        ],
        "summary": ["review_reason_count", "needs_review"],
        "status": ["status_mapping_status", "progress_reporting_status"],
        "money": ["budget"],
    },
    "point_mart": {
        "cells": ["is_mappable", "map_grid_latitude", "map_grid_longitude"],
        "status": ["hierarchy_status", "point_class"],
        "population": ["region_population", "area_population"],
        "money": ["budget"],
    },
}

KEYS = {
    "distribution_mart": ["level", "member_key", "cohort"],
    "equity_mart": ["member_key"],
    "alignment_mart": ["region_key", "point_class"],
    "monitoring_mart": ["project_key"],
    "point_mart": ["project_key"],
}


def sources(t):
    """Orders with what their customer and nation tell, written once for the five rebuilds."""
    last = t.orders.agg(F.max("o_orderdate").cast("date").alias("d"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    raw = rows.selectExpr(
        "o_orderkey AS project_key", "o_orderstatus AS st", "o_orderpriority AS pr", "CAST(o_orderdate AS DATE) AS od",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS price", "c_mktsegment AS seg", "c_acctbal AS bal",
        "n_nationkey AS n", "n_regionkey AS r",
    )
    told = raw.withColumn("snap", last.scalar()).selectExpr(
        "*", f"CASE WHEN NOT ({WITHHELD}) THEN price END AS budget", f"{POINT} AS mappable",
        f"CASE WHEN {NO_AREA} THEN 0 ELSE n + 1 END AS area",
        f"CASE WHEN pr = '5-LOW' THEN 0 WHEN {MOVED} THEN 1 + (r + 1) % 5 ELSE 1 + r END AS region",
    )
    return materialize(told, "rebuild-sources")


def people(t):
    """Persons per nation in the newest primary year, 2024; nation 13 has no member."""
    counted = t.customer.filter("c_nationkey <> 13").groupBy("c_nationkey").agg((F.count(F.lit(1)) * 1028).alias("persons"))
    return counted.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


def distribution(t, raw):
    cohort = F.expr("CASE WHEN NOT (pr = '3-MEDIUM' AND st = 'P') THEN CAST(year(od) AS BIGINT) END").alias("cohort")
    figures = [F.count(F.lit(1)).alias("project_count"), F.count("budget").alias("projects_with_budget"), F.sum("budget").alias("total_budget")]
    sides = []
    for level, key, everyone in (
        ("REGION", "region", t.region.select((F.col("r_regionkey") + 1).alias("member_key"))),
        ("REPORTING_AREA", "area", t.nation.select((F.col("n_nationkey") + 1).alias("member_key"))),
    ):
        cells = raw.filter(F.col(key) > 0).groupBy(F.col(key).alias("member_key"), cohort).agg(*figures)
        whole = raw.filter(F.col(key) > 0).groupBy(F.col(key).alias("member_key")).agg(
            F.count(F.lit(1)).alias("member_project_count"), F.sum("budget").alias("member_budget")
        )
        side = everyone.join(whole, "member_key", "left").join(cells, "member_key", "left")
        sides.append(side.fillna(0, ["project_count", "projects_with_budget", "member_project_count"]).withColumn("level", F.lit(level)))
    return sides[0].unionByName(sides[1])


def equity(t, raw):
    totals = raw.filter("area > 0").groupBy(F.col("area").alias("member_key")).agg(
        F.count(F.lit(1)).alias("project_count"), F.sum("budget").alias("total_budget")
    )
    persons = people(t).select((F.col("n_nationkey") + 1).alias("member_key"), F.col("persons").alias("population_count"))
    areas = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("member_key"), "r_name"
    )
    rows = areas.join(totals, "member_key", "left").join(persons, "member_key", "left").fillna(0, ["project_count"])
    rows = rows.selectExpr(
        "*", "CASE WHEN project_count = 0 THEN 'NO_MAPPED_PROJECT_DATA' WHEN r_name = 'MIDDLE EAST' THEN 'LIMITED_SOURCE_COVERAGE' ELSE 'REPORTED' END AS coverage"
    ).selectExpr(
        "*", "CASE WHEN coverage <> 'REPORTED' THEN 'EXCLUDED_SOURCE_COVERAGE' WHEN total_budget IS NULL THEN 'EXCLUDED_NO_REPORTED_BUDGET' WHEN population_count IS NULL THEN 'EXCLUDED_NO_POPULATION' ELSE 'COMPARABLE' END AS equity_status"
    )
    same = F.col("equity_status") == "COMPARABLE"
    money = F.when(same, F.col("total_budget"))
    rows = rows.withColumn("rate", per_unit(money, F.col("population_count")))
    # one row: sums and the rates of all areas, as many as there are nations
    whole = rows.agg(
        F.sum("population_count").alias("persons"), F.sum(money).alias("money"), F.collect_list("rate").alias("rates")
    )
    joined = rows.withColumn("all", whole.select(F.struct("*")).scalar())
    better = F.size(F.filter(F.col("all.rates"), lambda other: other > F.col("rate")))
    return joined.select(
        "member_key", "project_count", "population_count", "total_budget", "coverage", "equity_status",
        pct(F.col("population_count"), F.col("all.persons")).alias("population_share_pct"),
        pct(money, F.col("all.money")).alias("investment_share_pct"),
        F.col("rate").alias("investment_per_capita"), F.when(same, better + 1).cast("bigint").alias("per_capita_rank"),
    )


def point_class():
    return F.expr(
        "CASE WHEN NOT mappable THEN 'NO_USABLE_POINT' WHEN pr = '1-URGENT' THEN 'Very High' WHEN pr = '2-HIGH' THEN 'High' WHEN pr = '3-MEDIUM' THEN 'AMBIGUOUS' WHEN pr = '5-LOW' THEN 'Low' ELSE 'OUTSIDE_MAPPED_ZONES' END"
    ).alias("point_class")


def alignment(t, raw):
    flood = F.expr("coalesce(seg = 'MACHINERY' OR (seg = 'FURNITURE' AND pr IN ('1-URGENT', '2-HIGH')), FALSE)")
    listed = F.expr("price > 450000")
    cells = raw.filter("region > 0").groupBy(F.col("region").alias("region_key"), point_class()).agg(
        F.count(F.lit(1)).alias("project_count"), F.sum("budget").alias("total_budget"),
        F.count_if(flood).alias("flood_count"), F.sum(F.when(flood, F.col("budget"))).alias("flood_budget"),
        F.count_if(listed).alias("listed_count"), F.sum(F.when(listed, F.col("budget"))).alias("listed_budget"),
    )
    named = "'Low', 'Moderate', 'High', 'Very High', 'AMBIGUOUS', 'OUTSIDE_MAPPED_ZONES', 'NO_USABLE_POINT', 'INVALID_SOURCE'"
    grid = t.region.selectExpr("r_regionkey + 1 AS region_key", f"explode(array({named})) AS point_class")
    known = raw.filter("region > 0").select(F.col("region").alias("region_key")).distinct().withColumn("known", F.lit(True))
    full = grid.join(cells, ["region_key", "point_class"], "left").join(known, "region_key", "left")
    counts = {c: F.when(F.col("known"), F.coalesce(c, F.lit(0))) for c in ("project_count", "flood_count", "listed_count")}
    return full.withColumns(counts).drop("known")


def monitoring(t, raw):
    reasons = {
        "review_active_zero_progress": "st = 'O' AND pr = '1-URGENT'",
        "review_active_long_running": "st = 'O' AND n <> 9 AND od + INTERVAL 24 MONTH < snap",
        "review_active_progress_not_published": "st = 'O' AND pr = '2-HIGH'",
        "review_inactive_status": "st = 'F'",
        "review_unresolved_status": "st = 'P'",
    }
    told = raw.select("*", *[F.expr(rule).alias(name) for name, rule in reasons.items()])
    raised = F.size(F.array_compact(F.array(*[F.when(F.col(name), 1) for name in reasons]))).cast("bigint")
    return told.select(
        "project_key", "budget", *reasons, raised.alias("review_reason_count"), (raised > 0).alias("needs_review"),
        F.expr("CASE WHEN st <> 'P' THEN 'MAPPED' WHEN seg = 'BUILDING' THEN 'NO_SOURCE_STATUS' ELSE 'NO_APPROVED_STATUS_RULE' END").alias("status_mapping_status"),
        F.expr("CASE WHEN st = 'P' OR (st = 'O' AND pr = '2-HIGH') THEN 'NOT_PUBLISHED' WHEN st = 'O' AND pr = '1-URGENT' THEN 'ZERO' ELSE 'ABOVE_ZERO' END").alias("progress_reporting_status"),
    )


def points(t, raw):
    areas = people(t).select((F.col("n_nationkey") + 1).alias("area"), F.col("persons").alias("area_population"))
    regions = people(t).groupBy((F.col("n_regionkey") + 1).alias("region")).agg(F.sum("persons").alias("region_population"))
    return raw.join(areas, "area", "left").join(regions, "region", "left").select(
        "project_key", "budget", F.col("mappable").alias("is_mappable"), point_class(), "region_population", "area_population",
        F.expr("CASE WHEN mappable THEN floor((5 + bal / 1000) * 10) / 10 END").alias("map_grid_latitude"),
        F.expr("CASE WHEN mappable THEN floor((118 + n / 4) * 10) / 10 END").alias("map_grid_longitude"),
        F.expr(f"CASE WHEN {NO_AREA} THEN 'NOT_EVALUATED' WHEN {MOVED} THEN 'CONFLICT' ELSE 'CONSISTENT' END").alias("hierarchy_status"),
    )


REBUILDS = {
    "distribution_mart": distribution,
    "equity_mart": equity,
    "alignment_mart": alignment,
    "monitoring_mart": monitoring,
    "point_mart": points,
}
