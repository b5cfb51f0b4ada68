"""Marts on the star world (MRT*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.operators.windows import concentration, pct, per_unit
from verigrid.plans import marts
from verigrid.queries import star
from verigrid.queries.registry import query
from verigrid.queries.star import PROJECTS_SQL as W, d2

PCT = "ROUND(100.0::DOUBLE * CAST(%s AS DOUBLE) / NULLIF(CAST(%s AS DOUBLE), 0), 4)"


def share(part, whole):
    return PCT % (part, whole)


def unit(total, units):
    """Half-up money per unit from whole cents."""
    return f"CAST((2 * CAST(({total}) * 100 AS HUGEINT) + ({units})) // NULLIF(2 * ({units}), 0) AS DOUBLE) / 100"


GEO_SQL = f"""{W},
    placed AS (SELECT 'REGION' AS level, region_key AS member_key, infra_year AS cohort, project_key, budget FROM facts WHERE region_key <> 0 UNION ALL SELECT 'REPORTING_AREA', area_key, infra_year, project_key, budget FROM facts WHERE area_key <> 0),
    cohorts AS (SELECT level, member_key, cohort, COUNT(DISTINCT project_key) AS project_count, COUNT(budget) AS projects_with_budget, SUM(budget) AS total_budget FROM placed GROUP BY 1, 2, 3),
    totals AS (SELECT level, member_key, SUM(project_count) AS member_project_count, SUM(total_budget) AS member_budget FROM cohorts GROUP BY 1, 2),
    geo AS (SELECT m.level, m.member_key, m.member_name, m.is_limited, m.parent_key, CAST(coalesce(member_project_count, 0) AS BIGINT) AS member_project_count, member_budget,
        CASE WHEN coalesce(member_project_count, 0) = 0 THEN 'NO_MAPPED_PROJECT_DATA' WHEN is_limited THEN 'LIMITED_SOURCE_COVERAGE' ELSE 'REPORTED' END AS coverage FROM members m LEFT JOIN totals t ON t.level = m.level AND t.member_key = m.member_key)"""

MRT01 = f"""
    WITH {GEO_SQL},
    rg AS (SELECT *, {share('member_budget', 'SUM(member_budget) OVER (PARTITION BY level)')} AS member_share_pct, RANK() OVER (PARTITION BY level, coverage ORDER BY member_budget DESC NULLS LAST) AS mr, RANK() OVER (PARTITION BY level, coverage ORDER BY member_project_count DESC) AS mc,
        {share('SUM(member_budget) OVER (PARTITION BY level, coverage ORDER BY member_budget DESC NULLS LAST, member_key ROWS UNBOUNDED PRECEDING)', 'SUM(member_budget) OVER (PARTITION BY level)')} AS mcum FROM geo),
    cr AS (SELECT rg.*, c.cohort, CASE WHEN c.member_key IS NULL THEN 'NO_MAPPED_PROJECT' WHEN c.cohort IS NULL THEN 'NO_COHORT' ELSE 'COHORT' END AS cohort_row_type, CAST(coalesce(project_count, 0) AS BIGINT) AS project_count, CAST(coalesce(projects_with_budget, 0) AS BIGINT) AS projects_with_budget, total_budget
        FROM rg LEFT JOIN cohorts c ON c.level = rg.level AND c.member_key = rg.member_key),
    rc AS (SELECT *, {share('total_budget', 'SUM(total_budget) OVER (PARTITION BY level, cohort)')} AS cohort_share_pct, RANK() OVER (PARTITION BY level, cohort, coverage ORDER BY total_budget DESC NULLS LAST) AS crk, RANK() OVER (PARTITION BY level, cohort, coverage ORDER BY project_count DESC) AS cck,
        {share('SUM(total_budget) OVER (PARTITION BY level, cohort, coverage ORDER BY total_budget DESC NULLS LAST, member_key ROWS UNBOUNDED PRECEDING)', 'SUM(total_budget) OVER (PARTITION BY level, cohort)')} AS ccum FROM cr)
    SELECT level, member_key, member_name, coverage, cohort, cohort_row_type, project_count, projects_with_budget, CAST(total_budget AS DECIMAL(38,2)) AS total_budget, {unit('total_budget', 'projects_with_budget')} AS avg_budget, cohort_share_pct,
        CASE WHEN coverage = 'REPORTED' THEN crk END AS cohort_rank, CASE WHEN coverage = 'REPORTED' THEN cck END AS cohort_count_rank, CASE WHEN coverage = 'REPORTED' AND total_budget IS NOT NULL THEN ccum END AS cohort_cumulative_pct,
        member_project_count, CAST(member_budget AS DECIMAL(38,2)) AS member_budget, member_share_pct, CASE WHEN coverage = 'REPORTED' THEN mr END AS member_rank, CASE WHEN coverage = 'REPORTED' THEN mc END AS member_count_rank, CASE WHEN coverage = 'REPORTED' AND member_budget IS NOT NULL THEN mcum END AS member_cumulative_pct FROM rc"""


@query("mrt01", MRT01)
def mrt01(t):
    return star.distribution(t).select(
        "level", "member_key", "member_name", "coverage", "cohort", "cohort_row_type", "project_count",
        "projects_with_budget", d2("total_budget"), "avg_budget", "cohort_share_pct", "cohort_rank",
        "cohort_count_rank", "cohort_cumulative_pct", "member_project_count", d2("member_budget"),
        "member_share_pct", "member_rank", "member_count_rank", "member_cumulative_pct",
    )


EQUITY_SQL = f"""{GEO_SQL},
    comb AS (SELECT g.member_key, g.member_name, g.coverage, member_project_count AS project_count, member_budget AS total_budget, p.population_count,
        CASE WHEN coverage <> 'REPORTED' THEN 'EXCLUDED_SOURCE_COVERAGE' WHEN member_budget IS NULL THEN 'EXCLUDED_NO_REPORTED_BUDGET' WHEN p.population_count IS NULL THEN 'EXCLUDED_NO_POPULATION' ELSE 'COMPARABLE' END AS equity_status FROM geo g LEFT JOIN area_pop p ON p.area_key = g.member_key WHERE g.level = 'REPORTING_AREA'),
    cmp AS (SELECT *, CASE WHEN equity_status = 'COMPARABLE' THEN total_budget END AS cm, CASE WHEN equity_status = 'COMPARABLE' THEN population_count END AS cp FROM comb),
    sh AS (SELECT *, {share('population_count', 'SUM(population_count) OVER ()')} AS population_share_pct, {share('cp', 'SUM(cp) OVER ()')} AS comparable_population_share_pct, {share('cm', 'SUM(cm) OVER ()')} AS investment_share_pct, {unit('cm', 'cp')} AS investment_per_capita,
        CASE WHEN equity_status = 'COMPARABLE' THEN {unit('SUM(cm) OVER ()', 'CAST(SUM(cp) OVER () AS BIGINT)')} END AS comparable_set_per_capita FROM cmp)"""


def equity(t):
    people = star.area_population(t).withColumnRenamed("area_key", "member_key")
    return marts.equity(star.area_members(t), people)


@query(
    "mrt02",
    f"""WITH {EQUITY_SQL} SELECT member_key, member_name, coverage, equity_status, project_count, CAST(total_budget AS DECIMAL(38,2)) AS total_budget, population_count, population_share_pct, comparable_population_share_pct, investment_share_pct,
        ROUND(investment_share_pct - comparable_population_share_pct, 4) AS share_gap_pp, ROUND(investment_share_pct / NULLIF(comparable_population_share_pct, 0), 4) AS share_ratio, investment_per_capita, CASE WHEN equity_status = 'COMPARABLE' THEN RANK() OVER (PARTITION BY equity_status ORDER BY investment_per_capita DESC) END AS per_capita_rank, comparable_set_per_capita FROM sh""",
)
def mrt02(t):
    return equity(t).select(
        "member_key", "member_name", "coverage", "equity_status", "project_count", d2("total_budget"),
        "population_count", "population_share_pct", "comparable_population_share_pct", "investment_share_pct",
        "share_gap_pp", "share_ratio", "investment_per_capita", "per_capita_rank", "comparable_set_per_capita",
    )


ALIGN_SQL = f"""{GEO_SQL},
    classes(point_class, is_level, severity_rank) AS (VALUES ('Low', TRUE, 1), ('Moderate', TRUE, 2), ('High', TRUE, 3), ('Very High', TRUE, 4), ('AMBIGUOUS', FALSE, NULL), ('OUTSIDE_MAPPED_ZONES', FALSE, NULL), ('NO_USABLE_POINT', FALSE, NULL), ('INVALID_SOURCE', FALSE, NULL)),
    ct AS (SELECT region_key, point_class, COUNT(DISTINCT project_key) AS n, SUM(budget) AS b, COUNT(*) FILTER (WHERE is_flood) AS fn, SUM(budget) FILTER (WHERE is_flood) AS fb, COUNT(*) FILTER (WHERE sector = 'Flood Control and Drainage') AS sn, SUM(budget) FILTER (WHERE sector = 'Flood Control and Drainage') AS sb,
        COUNT(*) FILTER (WHERE in_list) AS ln, SUM(budget) FILTER (WHERE in_list) AS lb, COUNT(*) FILTER (WHERE is_flood IS NULL) AS un FROM facts WHERE region_key <> 0 GROUP BY 1, 2),
    es AS (SELECT region_key, CASE WHEN COUNT(*) FILTER (WHERE additivity_status = 'NOT_EVALUATED') > 0 THEN 'NOT_EVALUATED' WHEN COUNT(*) FILTER (WHERE additivity_status IS DISTINCT FROM 'ADDITIVE_WITHIN_TOLERANCE') > 0 THEN 'NON_ADDITIVE_CROSS_LEVEL_OVERLAP' ELSE 'ADDITIVE_WITHIN_TOLERANCE' END AS s FROM exposure GROUP BY 1)"""


def alignment(t):
    flags = {
        "flood": F.col("is_flood"),
        "single_sector": F.col("sector") == "Flood Control and Drainage",
        "listed": F.col("in_list"),
        "uncategorized": F.col("is_flood").isNull(),
    }
    return marts.class_alignment(
        star.facts(t), star.region_members(t), star.classes(t), flags, star.exposure(t)
    )


@query(
    "mrt03",
    f"""WITH {ALIGN_SQL} SELECT g.member_key AS region_key, g.member_name AS region_name, g.coverage, c.point_class, c.is_level, c.severity_rank, CASE WHEN coverage <> 'NO_MAPPED_PROJECT_DATA' THEN CAST(coalesce(n, 0) AS BIGINT) END AS project_count, CAST(b AS DECIMAL(38,2)) AS total_budget, CAST(coalesce(fn, 0) AS BIGINT) AS flood_count, CAST(fb AS DECIMAL(38,2)) AS flood_budget,
        CAST(coalesce(sn, 0) AS BIGINT) AS single_sector_count, CAST(sb AS DECIMAL(38,2)) AS single_sector_budget, CAST(coalesce(ln, 0) AS BIGINT) AS listed_count, CAST(lb AS DECIMAL(38,2)) AS listed_budget, CAST(coalesce(un, 0) AS BIGINT) AS uncategorized_count,
        {share('coalesce(fn, 0)', 'SUM(coalesce(fn, 0)) OVER (PARTITION BY g.member_key)')} AS share_of_region_projects_pct, {share('fb', 'SUM(fb) OVER (PARTITION BY g.member_key)')} AS share_of_region_budget_pct, e.susceptible_area_sqkm, coalesce(es.s, 'NO_EXPOSURE_DATA') AS exposure_area_status
      FROM geo g CROSS JOIN classes c LEFT JOIN ct ON ct.region_key = g.member_key AND ct.point_class = c.point_class LEFT JOIN exposure e ON e.region_key = g.member_key AND e.level = c.point_class LEFT JOIN es ON es.region_key = g.member_key WHERE g.level = 'REGION'""",
)
def mrt03(t):
    return alignment(t).select(
        "region_key", "region_name", "coverage", "point_class", "is_level", "severity_rank", "project_count",
        d2("total_budget"), "flood_count", d2("flood_budget"), "single_sector_count", d2("single_sector_budget"),
        "listed_count", d2("listed_budget"), "uncategorized_count", "share_of_region_projects_pct",
        "share_of_region_budget_pct", "susceptible_area_sqkm", "exposure_area_status",
    )


MONITOR_SQL = f"""{W},
    ind AS (SELECT *, coalesce(status_group = 'ACTIVE' AND standardized_status IS DISTINCT FROM 'For Procurement' AND zero_progress_flag, FALSE) AS a, coalesce(status_group = 'ACTIVE' AND long_running_flag, FALSE) AS b,
        coalesce(status_group = 'ACTIVE' AND standardized_status IS DISTINCT FROM 'For Procurement' AND physical_progress_pct IS NULL, FALSE) AS c, coalesce(status_group = 'INACTIVE', FALSE) AS d, status_group IS NULL AS e FROM facts),
    mon AS (SELECT *, CAST(a::INT + b::INT + c::INT + d::INT + e::INT AS BIGINT) AS review_reason_count FROM ind)"""


@query(
    "mrt04",
    f"""WITH {MONITOR_SQL} SELECT project_key, region_key, area_key, CASE WHEN status_key = 0 THEN 'NO_SOURCE_STATUS' WHEN status_group IS NULL THEN 'NO_APPROVED_STATUS_RULE' ELSE 'MAPPED' END AS status_mapping_status, CASE WHEN physical_progress_pct IS NULL THEN 'NOT_PUBLISHED' WHEN physical_progress_pct = 0 THEN 'ZERO' ELSE 'ABOVE_ZERO' END AS progress_reporting_status,
        zero_progress_flag, long_running_flag, budget, a AS review_active_zero_progress, b AS review_active_long_running, c AS review_active_progress_not_published, d AS review_inactive_status, e AS review_unresolved_status, review_reason_count, review_reason_count > 0 AS needs_review FROM mon""",
)
def mrt04(t):
    return marts.monitoring(star.facts(t)).select(
        "project_key", "region_key", "area_key", "status_mapping_status", "progress_reporting_status",
        "zero_progress_flag", "long_running_flag", "budget", "review_active_zero_progress",
        "review_active_long_running", "review_active_progress_not_published", "review_inactive_status",
        "review_unresolved_status", "review_reason_count", "needs_review",
    )


HIER = "CASE WHEN f.region_key = 0 OR f.area_key = 0 THEN 'NOT_EVALUATED' WHEN area_region_key = f.region_key THEN 'CONSISTENT' ELSE 'CONFLICT' END"


@query(
    "mrt05",
    f"""WITH {W} SELECT project_key, coordinate_status = 'VALID_PAIR' AS is_mappable, floor(latitude * 10) / 10 AS map_grid_latitude, floor(longitude * 10) / 10 AS map_grid_longitude, f.region_key, f.area_key, {HIER} AS hierarchy_status, point_class, rp.population_count AS region_population, ap.population_count AS area_population, budget
        FROM facts f LEFT JOIN region_pop rp ON rp.region_key = f.region_key LEFT JOIN area_pop ap ON ap.area_key = f.area_key""",
)
def mrt05(t):
    view = marts.point_view(star.facts(t), star.region_population(t), star.area_population(t))
    return view.select(
        "project_key", "is_mappable", "map_grid_latitude", "map_grid_longitude", "region_key", "area_key",
        "hierarchy_status", "point_class", "region_population", "area_population", "budget",
    )


@query(
    "mrt06",
    f"""WITH {W}, ctx AS (SELECT f.*, {HIER} AS hier, rp.population_count AS rpop, ap.population_count AS apop FROM facts f LEFT JOIN region_pop rp ON rp.region_key = f.region_key LEFT JOIN area_pop ap ON ap.area_key = f.area_key),
    lk AS (SELECT region_key, budget, unnest([
        {{'l': 'budget', 'o': CASE WHEN budget > 0 THEN 'given' WHEN budget IS NULL THEN 'missing' ELSE 'zero' END, 'k': budget IS NOT NULL}}, {{'l': 'in_list', 'o': CASE WHEN in_list THEN 'marked' ELSE 'unmarked' END, 'k': in_list}},
        {{'l': 'coordinate_status', 'o': coordinate_status, 'k': coordinate_status = 'VALID_PAIR'}}, {{'l': 'hierarchy_status', 'o': hier, 'k': hier = 'CONSISTENT'}}, {{'l': 'class_match_status', 'o': class_match_status, 'k': class_match_status = 'MATCHED'}},
        {{'l': 'region_key', 'o': region_match_status, 'k': region_key <> 0}}, {{'l': 'area_key', 'o': area_match_status, 'k': area_key <> 0}},
        {{'l': 'region_population', 'o': CASE WHEN region_key = 0 THEN 'no member' WHEN rpop IS NULL THEN 'member without value' ELSE 'value' END, 'k': region_key <> 0 AND rpop IS NOT NULL}},
        {{'l': 'area_population', 'o': CASE WHEN area_key = 0 THEN 'no member' WHEN apop IS NULL THEN 'member without value' ELSE 'value' END, 'k': area_key <> 0 AND apop IS NOT NULL}},
        {{'l': 'sector', 'o': sector_status, 'k': sector IS NOT NULL}}, {{'l': 'status_group', 'o': CASE WHEN status_key = 0 THEN 'NO_SOURCE_STATUS' WHEN status_group IS NULL THEN 'NO_APPROVED_STATUS_RULE' ELSE 'MAPPED' END, 'k': status_group IS NOT NULL}}]) AS x FROM ctx),
    tt AS (SELECT x.l AS integration_link, x.o AS link_outcome, coalesce(x.k, FALSE) AS is_linked, region_key, COUNT(*) AS n, COUNT(budget) AS nb, SUM(budget) AS b FROM lk GROUP BY ALL)
    SELECT integration_link, link_outcome, is_linked, region_key, CAST(n AS BIGINT) AS project_count, CAST(nb AS BIGINT) AS projects_with_budget, CAST(b AS DECIMAL(38,2)) AS total_budget, {share('n', 'SUM(n) OVER (PARTITION BY integration_link)')} AS pct_of_link_projects, {share('b', 'SUM(b) OVER (PARTITION BY integration_link)')} AS pct_of_link_budget, {share('n', 'SUM(n) OVER (PARTITION BY integration_link, region_key)')} AS pct_of_region_projects FROM tt""",
)
def mrt06(t):
    context = marts.point_view(star.facts(t), star.region_population(t), star.area_population(t))
    covered = marts.link_coverage(context, star.LINKS)
    return covered.withColumn("total_budget", d2("total_budget"))


@query(
    "mrt07",
    f"WITH {GEO_SQL} SELECT level, member_key, coverage, CASE WHEN coverage = 'REPORTED' THEN RANK() OVER (PARTITION BY level, coverage ORDER BY member_budget DESC NULLS LAST) END AS reported_rank FROM geo",
)
def mrt07(t):
    rows = star.distribution(t).select("level", "member_key", "coverage", F.col("member_rank").alias("reported_rank"))
    return rows.distinct()


@query(
    "mrt08",
    f"""WITH {GEO_SQL} SELECT 'investment_distribution' AS view_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM geo LEFT JOIN cohorts ON cohorts.level = geo.level AND cohorts.member_key = geo.member_key
        UNION ALL SELECT 'population_equity', COUNT(*) FROM geo WHERE level = 'REPORTING_AREA' UNION ALL SELECT 'implementation_monitoring', COUNT(*) FROM facts""",
)
def mrt08(t):
    return marts.inventory(
        {
            "investment_distribution": star.distribution(t),
            "population_equity": equity(t),
            "implementation_monitoring": marts.monitoring(star.facts(t)),
        }
    )


@query(
    "mrt09",
    f"""WITH {MONITOR_SQL} SELECT CAST(COUNT(*) AS BIGINT) AS projects, CAST(SUM(budget) AS DECIMAL(38,2)) AS total_budget, {share("COUNT(*) FILTER (WHERE standardized_status = 'Completed')", 'COUNT(*)')} AS completed_pct, {share('COUNT(*) FILTER (WHERE review_reason_count > 0)', 'COUNT(*)')} AS flagged_pct,
        {share("SUM(budget) FILTER (WHERE point_class IN ('High', 'Very High'))", 'SUM(budget)')} AS high_risk_budget_pct FROM mon""",
)
def mrt09(t):
    rows = marts.monitoring(star.facts(t))
    high = F.col("point_class").isin("High", "Very High")
    return rows.agg(
        F.count(F.lit(1)).alias("projects"),
        F.sum("budget").cast("decimal(38,2)").alias("total_budget"),
        pct(F.count_if(F.col("standardized_status") == "Completed"), F.count(F.lit(1))).alias("completed_pct"),
        pct(F.count_if("needs_review"), F.count(F.lit(1))).alias("flagged_pct"),
        pct(F.sum(F.when(high, F.col("budget"))), F.sum("budget")).alias("high_risk_budget_pct"),
    )


@query(
    "mrt10",
    f"""WITH {GEO_SQL}, y AS (SELECT member_key, cohort AS year, total_budget FROM cohorts WHERE level = 'REPORTING_AREA' AND cohort IS NOT NULL),
    r AS (SELECT *, {share('total_budget', 'SUM(total_budget) OVER (PARTITION BY year)')} AS year_share_pct, ROW_NUMBER() OVER (PARTITION BY year ORDER BY total_budget DESC NULLS LAST, member_key) AS place, SUM(total_budget) OVER (PARTITION BY year ORDER BY total_budget DESC NULLS LAST, member_key ROWS UNBOUNDED PRECEDING) AS run, SUM(total_budget) OVER (PARTITION BY year) AS tot, COUNT(*) OVER (PARTITION BY year) AS k FROM y)
    SELECT member_key, year, CAST(total_budget AS DECIMAL(38,2)) AS total_budget, year_share_pct, CAST(place AS BIGINT) AS place, CASE WHEN total_budget IS NOT NULL THEN {share('run', 'tot')} END AS cumulative_share_pct, place <= 3 AS is_top_three, CASE WHEN place = 1 THEN 'MOST_FUNDED' WHEN place = k THEN 'LEAST_FUNDED' END AS extreme FROM r""",
)
def mrt10(t):
    from pyspark.sql import Window

    yearly = star.facts(t).filter("area_key <> 0 and infra_year is not null").groupBy(
        F.col("area_key").alias("member_key"), F.col("infra_year").alias("year")
    ).agg(F.sum("budget").alias("total_budget"))
    year = Window.partitionBy("year")
    placed = concentration(yearly, ["year"], "total_budget", "member_key")
    return placed.select(
        "member_key", "year", d2("total_budget"),
        pct(F.col("total_budget"), F.sum("total_budget").over(year)).alias("year_share_pct"),
        "place", "cumulative_share_pct", (F.col("place") <= 3).alias("is_top_three"),
        F.when(F.col("place") == 1, "MOST_FUNDED")
        .when(F.col("place") == F.count(F.lit(1)).over(year), "LEAST_FUNDED")
        .alias("extreme"),
    )


@query(
    "mrt11",
    f"""WITH {MONITOR_SQL} SELECT region_key, sector, infra_year, CAST(COUNT(*) AS BIGINT) AS projects, {share("COUNT(*) FILTER (WHERE standardized_status = 'Completed')", 'COUNT(*)')} AS completed_pct, ROUND(AVG(CASE WHEN standardized_status = 'Completed' AND completion_date >= start_date THEN date_diff('day', start_date, completion_date) / 30.4375 END), 2) AS months_to_complete,
        CAST(COUNT(*) FILTER (WHERE review_reason_count > 0) AS BIGINT) AS flagged_projects FROM mon GROUP BY ALL""",
)
def mrt11(t):
    rows = marts.monitoring(star.facts(t))
    done = (F.col("standardized_status") == "Completed") & (F.col("completion_date") >= F.col("start_date"))
    months = F.datediff("completion_date", "start_date") / F.lit(30.4375)
    return rows.groupBy("region_key", "sector", "infra_year").agg(
        F.count(F.lit(1)).alias("projects"),
        pct(F.count_if(F.col("standardized_status") == "Completed"), F.count(F.lit(1))).alias("completed_pct"),
        F.round(F.avg(F.when(done, months)), 2).alias("months_to_complete"),
        F.count_if("needs_review").alias("flagged_projects"),
    )


@query(
    "mrt12",
    f"""WITH {W}, g AS (SELECT region_key, sector, CASE WHEN sector = 'Multi-sector' THEN 'MULTI' WHEN sector IS NULL THEN 'UNRESOLVED' ELSE 'SINGLE' END AS sector_kind, COUNT(*) AS n, SUM(budget) AS b FROM facts WHERE region_key <> 0 GROUP BY ALL)
    SELECT region_key, sector, sector_kind, CAST(n AS BIGINT) AS projects, CAST(b AS DECIMAL(38,2)) AS total_budget, {share('b', 'SUM(b) OVER (PARTITION BY region_key)')} AS share_of_region_pct FROM g""",
)
def mrt12(t):
    from pyspark.sql import Window

    kind = F.when(F.col("sector") == "Multi-sector", "MULTI").when(F.col("sector").isNull(), "UNRESOLVED").otherwise("SINGLE")
    grouped = star.facts(t).filter("region_key <> 0").groupBy("region_key", "sector", kind.alias("sector_kind")).agg(
        F.count(F.lit(1)).alias("projects"), F.sum("budget").alias("total_budget")
    )
    region = Window.partitionBy("region_key")
    return grouped.select(
        "region_key", "sector", "sector_kind", "projects", d2("total_budget"),
        pct(F.col("total_budget"), F.sum("total_budget").over(region)).alias("share_of_region_pct"),
    )


@query(
    "mrt13",
    f"""WITH {EQUITY_SQL}, y AS (SELECT c.member_key, c.cohort AS year, c.total_budget AS yb, sh.equity_status, sh.cp FROM cohorts c JOIN sh ON sh.member_key = c.member_key WHERE c.level = 'REPORTING_AREA' AND c.cohort IS NOT NULL AND sh.equity_status = 'COMPARABLE')
    SELECT member_key, year, CAST(yb AS DECIMAL(38,2)) AS total_budget, {unit('yb', 'cp')} AS money_per_person, CAST(RANK() OVER (PARTITION BY year ORDER BY {unit('yb', 'cp')} ASC NULLS LAST) AS BIGINT) AS look_first_rank FROM y""",
)
def mrt13(t):
    from pyspark.sql import Window

    comparable = equity(t).filter("equity_status = 'COMPARABLE'").select("member_key", "population_count")
    yearly = star.facts(t).filter("area_key <> 0 and infra_year is not null").groupBy(
        F.col("area_key").alias("member_key"), F.col("infra_year").alias("year")
    ).agg(F.sum("budget").alias("total_budget"))
    rate = per_unit(F.col("total_budget"), F.col("population_count"))
    rated = yearly.join(comparable, "member_key").withColumn("money_per_person", rate)
    lowest = Window.partitionBy("year").orderBy(F.col("money_per_person").asc_nulls_last())
    return rated.select(
        "member_key", "year", d2("total_budget"), "money_per_person",
        F.rank().over(lowest).cast("bigint").alias("look_first_rank"),
    )


@query(
    "mrt14",
    f"""WITH {W} SELECT point_class, CAST(COUNT(*) AS BIGINT) AS projects, {share("COUNT(*) FILTER (WHERE standardized_status = 'Completed')", 'COUNT(*)')} AS completed_pct, {unit('SUM(budget)', 'COUNT(budget)')} AS money_per_project FROM facts GROUP BY 1""",
)
def mrt14(t):
    return star.facts(t).groupBy("point_class").agg(
        F.count(F.lit(1)).alias("projects"),
        pct(F.count_if(F.col("standardized_status") == "Completed"), F.count(F.lit(1))).alias("completed_pct"),
        per_unit(F.sum("budget"), F.count("budget")).alias("money_per_project"),
    )
