"""Decision-ready marts over the star schema (MRT*).

Facts are reduced to one row per member, cohort and class before anything else
happens, with map-side combined counts and sums. Ranks and shares then run on the
members only. Projects are unique per fact row (``model.fact_checks`` proves it), so
a row count is the distinct project count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.operators.scale import attach_total, lookup
from verigrid.operators.windows import pct, per_unit

REPORTED, LIMITED, NO_DATA = "REPORTED", "LIMITED_SOURCE_COVERAGE", "NO_MAPPED_PROJECT_DATA"
COMPARABLE = "COMPARABLE"


def count_money(money: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("project_count"),
        F.count(money).alias("projects_with_budget"),
        F.sum(money).alias("total_budget"),
    ]


def coverage_status(count: Column, limited: Column) -> Column:
    """Coverage of a member; only REPORTED members are ranked."""
    return (
        F.when(F.coalesce(count, F.lit(0)) == 0, NO_DATA)
        .when(F.coalesce(limited, F.lit(False)), LIMITED)
        .otherwise(REPORTED)
    )


def cohort_totals(facts: DataFrame, levels: Mapping[str, str], cohort: str, money: str) -> DataFrame:
    """Counts and money per level, member and cohort from one pass over the facts; key 0 stays out."""
    placed = F.array(
        *[F.struct(F.lit(level).alias("level"), F.col(key).alias("member_key")) for level, key in levels.items()]
    )
    rows = facts.select(F.explode(placed).alias("g"), F.col(cohort).alias("cohort"), money)
    rows = rows.select("g.level", "g.member_key", "cohort", money).filter("member_key <> 0")
    return rows.groupBy("level", "member_key", "cohort").agg(*count_money(money))


def distribution(
    facts: DataFrame, members: DataFrame, levels: Mapping[str, str], cohort: str, money: str
) -> DataFrame:
    """Investment per level, member and cohort with shares, ranks and cumulative shares.

    ``members`` has level, member_key, member_name and is_limited. Share denominators
    include every member of the level; ranks and running shares only REPORTED ones. A
    member with no project keeps one row, a NULL cohort is its own cohort.
    """
    cohorts = cohort_totals(facts, levels, cohort, money)
    totals = cohorts.groupBy("level", "member_key").agg(
        F.sum("project_count").alias("member_project_count"), F.sum("total_budget").alias("member_budget")
    )
    placed = members.join(totals, ["level", "member_key"], "left").withColumn(
        "member_project_count", F.coalesce("member_project_count", F.lit(0))
    )
    placed = placed.withColumn(
        "coverage", coverage_status(F.col("member_project_count"), F.col("is_limited"))
    )

    def ranked(df: DataFrame, group: Sequence[str], money_col: str, count_col: str, prefix: str) -> DataFrame:
        peers = W.partitionBy(*group, "coverage")
        by_money = F.col(money_col).desc_nulls_last()
        whole = F.sum(money_col).over(W.partitionBy(*group))
        running = F.sum(money_col).over(
            peers.orderBy(by_money, "member_key").rowsBetween(W.unboundedPreceding, 0)
        )
        reported = F.col("coverage") == REPORTED
        return df.withColumns(
            {
                f"{prefix}_share_pct": pct(F.col(money_col), whole),
                f"{prefix}_rank": F.when(reported, F.rank().over(peers.orderBy(by_money)).cast("bigint")),
                f"{prefix}_count_rank": F.when(
                    reported, F.rank().over(peers.orderBy(F.col(count_col).desc())).cast("bigint")
                ),
                f"{prefix}_cumulative_pct": F.when(
                    reported & F.col(money_col).isNotNull(), pct(running, whole)
                ),
            }
        )

    placed = ranked(placed, ["level"], "member_budget", "member_project_count", "member")
    rows = placed.join(
        cohorts.withColumn("__hit", F.lit(True)), ["level", "member_key"], "left"
    ).withColumns(
        {
            "cohort_row_type": F.when(F.col("__hit").isNull(), "NO_MAPPED_PROJECT")
            .when(F.col("cohort").isNull(), "NO_COHORT")
            .otherwise("COHORT"),
            "project_count": F.coalesce("project_count", F.lit(0)),
            "projects_with_budget": F.coalesce("projects_with_budget", F.lit(0)),
        }
    ).drop("__hit")
    rows = ranked(rows, ["level", "cohort"], "total_budget", "project_count", "cohort")
    return rows.withColumn(
        "avg_budget", per_unit(F.col("total_budget"), F.col("projects_with_budget"))
    )


def newest_primary(population: DataFrame, key: str) -> DataFrame:
    """Primary-source rows of the newest year only, so two years never add up."""
    primary = population.filter(F.col("is_primary_source") & (F.col(key) != 0))
    return attach_total(primary, {"__newest": F.max("reference_year")}).filter(
        "reference_year = __newest"
    ).drop("__newest")


def equity(members: DataFrame, population: DataFrame) -> DataFrame:
    """Share of money against share of people over one comparable set.

    ``members`` has member_key, coverage, project_count, total_budget; ``population``
    has member_key, population_count, reference_year. The exclusion reason is the
    first failing test.
    """
    combined = members.join(population, "member_key", "left")
    status = (
        F.when(F.col("coverage") != REPORTED, "EXCLUDED_SOURCE_COVERAGE")
        .when(F.col("total_budget").isNull(), "EXCLUDED_NO_REPORTED_BUDGET")
        .when(F.col("population_count").isNull(), "EXCLUDED_NO_POPULATION")
        .otherwise(COMPARABLE)
    )
    comparable = F.col("equity_status") == COMPARABLE
    masked = combined.withColumn("equity_status", status).withColumns(
        {
            "__money": F.when(comparable, F.col("total_budget")),
            "__people": F.when(comparable, F.col("population_count")),
        }
    )
    whole = attach_total(
        masked,
        {"__all": F.sum("population_count"), "__all_money": F.sum("__money"), "__all_people": F.sum("__people")},
    )
    shared = whole.withColumns(
        {
            "population_share_pct": pct(F.col("population_count"), F.col("__all")),
            "comparable_population_share_pct": pct(F.col("__people"), F.col("__all_people")),
            "investment_share_pct": pct(F.col("__money"), F.col("__all_money")),
            "investment_per_capita": per_unit(F.col("__money"), F.col("__people")),
            "comparable_set_per_capita": F.when(
                comparable, per_unit(F.col("__all_money"), F.col("__all_people"))
            ),
        }
    )
    investment, people = F.col("investment_share_pct"), F.col("comparable_population_share_pct")
    by_rate = W.partitionBy("equity_status").orderBy(F.col("investment_per_capita").desc())
    return shared.withColumns(
        {
            "share_gap_pp": F.round(investment - people, 4),
            "share_ratio": F.round(F.when(people != 0, investment / people), 4),
            "per_capita_rank": F.when(comparable, F.rank().over(by_rate).cast("bigint")),
        }
    ).drop("__money", "__people", "__all", "__all_money", "__all_people")


def point_class(status: str = "class_match_status", coordinates: str = "coordinate_status", level: str = "level") -> Column:
    """The class of a project's point; outside the mapped zones is not low risk."""
    unmatched = F.col(status) == "UNMATCHED"
    return (
        F.when(F.col(status) == "MATCHED", F.col(level))
        .when(unmatched & (F.col(coordinates) == "VALID_PAIR"), "OUTSIDE_MAPPED_ZONES")
        .when(unmatched, "NO_USABLE_POINT")
        .otherwise(F.col(status))
    )


def exposure_status() -> Column:
    """One additivity status per region: not evaluated wins, then any non-additive level."""
    state = F.col("additivity_status")
    return (
        F.when(F.count_if(state == "NOT_EVALUATED") > 0, "NOT_EVALUATED")
        .when(
            F.count_if(~state.eqNullSafe("ADDITIVE_WITHIN_TOLERANCE")) > 0,
            "NON_ADDITIVE_CROSS_LEVEL_OVERLAP",
        )
        .otherwise("ADDITIVE_WITHIN_TOLERANCE")
    )


def class_alignment(
    facts: DataFrame, regions: DataFrame, classes: DataFrame, flags: Mapping[str, Column], exposure: DataFrame
) -> DataFrame:
    """Region x point class grid with counts and money per flag, and exposure area.

    ``regions`` has region_key, region_name, is_limited; coverage follows from the same
    totals. Counts are 0 where the region has data and NULL where it has none; money is
    never turned into 0.
    """
    totals = facts.filter("region_key <> 0").groupBy("region_key", "point_class").agg(
        F.count(F.lit(1)).alias("project_count"),
        F.sum("budget").alias("total_budget"),
        *[F.count_if(cond).alias(f"{name}_count") for name, cond in flags.items()],
        *[F.sum(F.when(cond, F.col("budget"))).alias(f"{name}_budget") for name, cond in flags.items()],
    )
    counts = ["project_count", *[f"{name}_count" for name in flags]]
    mapped = totals.groupBy("region_key").agg(F.sum("project_count").alias("__mapped"))
    regions = regions.join(mapped, "region_key", "left").withColumn(
        "coverage", coverage_status(F.col("__mapped"), F.col("is_limited"))
    ).drop("__mapped", "is_limited")
    per_region = exposure.groupBy("region_key").agg(exposure_status().alias("exposure_area_status"))
    grid = lookup(regions.crossJoin(classes), totals, ["region_key", "point_class"], "left")
    grid = grid.join(
        exposure.select("region_key", F.col("level").alias("point_class"), "susceptible_area_sqkm"),
        ["region_key", "point_class"], "left",
    ).join(per_region, "region_key", "left")
    has_data = F.col("coverage") != NO_DATA
    filled = grid.withColumns(
        {
            **{name: F.when(has_data, F.coalesce(name, F.lit(0))) for name in counts},
            "exposure_area_status": F.coalesce("exposure_area_status", F.lit("NO_EXPOSURE_DATA")),
        }
    )
    region = W.partitionBy("region_key")
    first = next(iter(flags))
    return filled.withColumns(
        {
            "share_of_region_projects_pct": pct(
                F.col(f"{first}_count"), F.sum(f"{first}_count").over(region)
            ),
            "share_of_region_budget_pct": pct(
                F.col(f"{first}_budget"), F.sum(f"{first}_budget").over(region)
            ),
        }
    )


def status_mapping() -> Column:
    return (
        F.when(F.col("status_key") == 0, "NO_SOURCE_STATUS")
        .when(F.col("status_group").isNull(), "NO_APPROVED_STATUS_RULE")
        .otherwise("MAPPED")
    )


def hierarchy_status(area_region: str = "area_region_key") -> Column:
    return (
        F.when((F.col("region_key") == 0) | (F.col("area_key") == 0), "NOT_EVALUATED")
        .when(F.col(area_region) == F.col("region_key"), "CONSISTENT")
        .otherwise("CONFLICT")
    )


def monitoring(facts: DataFrame) -> DataFrame:
    """One row per project with five review indicators; a missing input never raises one.

    ``facts`` carry status_key, status_group, standardized_status, physical_progress_pct,
    zero_progress_flag and long_running_flag.
    """
    active = F.col("status_group") == "ACTIVE"
    procurement = F.col("standardized_status").eqNullSafe("For Procurement")
    progress = F.col("physical_progress_pct")
    raised = {
        "review_active_zero_progress": active & ~procurement & F.col("zero_progress_flag"),
        "review_active_long_running": active & F.col("long_running_flag"),
        "review_active_progress_not_published": active & ~procurement & progress.isNull(),
        "review_inactive_status": F.col("status_group") == "INACTIVE",
        "review_unresolved_status": F.col("status_group").isNull(),
    }
    flagged = facts.withColumns(
        {name: F.coalesce(cond, F.lit(False)) for name, cond in raised.items()}
    )
    count = sum((F.col(name).cast("bigint") for name in raised), F.lit(0).cast("bigint"))
    return flagged.withColumns(
        {
            "status_mapping_status": status_mapping(),
            "progress_reporting_status": F.when(progress.isNull(), "NOT_PUBLISHED")
            .when(progress == 0, "ZERO")
            .otherwise("ABOVE_ZERO"),
            "review_reason_count": count,
            "needs_review": count > 0,
        }
    )


def point_view(facts: DataFrame, region_population: DataFrame, area_population: DataFrame) -> DataFrame:
    """One row per project with its point, display cell, hierarchy agreement and population."""
    mappable = F.col("coordinate_status").eqNullSafe("VALID_PAIR")
    joined = facts.join(
        region_population.select("region_key", F.col("population_count").alias("region_population")),
        "region_key", "left",
    ).join(
        area_population.select("area_key", F.col("population_count").alias("area_population")),
        "area_key", "left",
    )
    return joined.withColumns(
        {
            "is_mappable": mappable,
            "map_grid_latitude": F.when(mappable, F.floor(F.col("latitude") * 10) / 10),
            "map_grid_longitude": F.when(mappable, F.floor(F.col("longitude") * 10) / 10),
            "hierarchy_status": hierarchy_status(),
            "status_mapping_status": status_mapping(),
            "point_class": point_class(),
        }
    )


@dataclass(frozen=True)
class Link:
    """A column that shows a link, the kind of evidence in it, and what else the kind needs."""

    column: str
    kind: str
    by: str = ""


def outcome(link: Link) -> tuple[Column, Column]:
    """(outcome, whether the project is linked) by the kind of evidence."""
    value = F.col(link.column)
    if link.kind == "member":  # key 0 stands for no member
        return F.col(link.by), value != 0
    if link.kind == "group":
        return F.col(link.by), value.isNotNull()
    if link.kind == "status":
        return value, value == link.by
    if link.kind == "mark":
        return F.when(value, "marked").otherwise("unmarked"), value
    if link.kind == "amount":
        return F.when(value.isNull(), "missing").when(value == 0, "zero").otherwise("given"), value.isNotNull()
    if link.kind == "value":
        reached = F.col(link.by) != 0
        told = F.when(~reached, "no member").when(value.isNull(), "member without value").otherwise("value")
        return told, reached & value.isNotNull()
    raise ValueError(f"unknown kind of link: {link.kind}")


def link_coverage(facts: DataFrame, links: Sequence[Link], money: str = "budget") -> DataFrame:
    """Every project once per link: outcome counts and money with shares; the facts are read once."""
    found = [(link.column, *outcome(link)) for link in links]
    each = F.array(*[F.struct(F.lit(n).alias("integration_link"), o.alias("link_outcome"), F.coalesce(k, F.lit(False)).alias("is_linked")) for n, o, k in found])
    rows = facts.select("region_key", money, F.inline(each))
    totals = rows.groupBy("integration_link", "link_outcome", "is_linked", "region_key").agg(
        *count_money(money)
    )
    link = W.partitionBy("integration_link")
    cell = W.partitionBy("integration_link", "region_key")
    return totals.withColumns(
        {
            "pct_of_link_projects": pct(F.col("project_count"), F.sum("project_count").over(link)),
            "pct_of_link_budget": pct(F.col("total_budget"), F.sum("total_budget").over(link)),
            "pct_of_region_projects": pct(F.col("project_count"), F.sum("project_count").over(cell)),
        }
    )


def inventory(views: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per published view."""
    out = None
    for name, view in views.items():
        part = view.agg(F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("row_count"))
        out = part if out is None else out.unionByName(part)
    return out
