"""Star schema builders: dimensions with an unknown member, facts with key 0 (DIM*, FCT*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.functions.dates import date_key, spans_more_than, zero_progress
from verigrid.functions.geometry import centroid
from verigrid.functions.identity import run_id, surrogate_key
from verigrid.operators.scale import latest_per_key, with_context
from verigrid.operators.versions import valid_version


def with_unknown(df: DataFrame, key: str, defaults: Mapping[str, str]) -> DataFrame:
    """Add the reserved member 0; columns without a default stay NULL."""
    spark = df.sparkSession
    columns = []
    for part in df.schema:
        if part.name == key:
            columns.append(F.lit(0).cast(part.dataType).alias(key))
        else:
            columns.append(F.lit(defaults.get(part.name)).cast(part.dataType).alias(part.name))
    return df.unionByName(spark.range(1).select(*columns))


def dimension(
    df: DataFrame, key: str, label: str, natural: Sequence[str], defaults: Mapping[str, str]
) -> DataFrame:
    """Dimension members keyed by label and natural key, plus the unknown member."""
    keyed = df.withColumn(key, surrogate_key(label, *[F.col(name) for name in natural]))
    return with_unknown(keyed.select(key, *df.columns), key, defaults)


def calendar(spark: SparkSession, first: Column, last: Column, bounds: DataFrame | None = None) -> DataFrame:
    """One row per day between two dates, plus key 0 for the unknown day."""
    base = spark.range(1) if bounds is None else bounds
    days = base.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("calendar_date"))
    day = F.col("calendar_date")
    dated = days.select(
        date_key(day).alias("date_key"), "calendar_date",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )
    return with_unknown(dated, "date_key", {"month_name": "Unknown", "year_month": "Unknown"})


def boundary_dimension(members: DataFrame, boundaries: DataFrame, key: str) -> DataFrame:
    """Boundaries by member and version: published with shape and centroid, or only counted.

    ``members`` has ``key`` and code, ``boundaries`` has code, boundary_version and rings. A member with
    one shape in a version gets a row with its key, rings, whether they enclose an area, and centroid.
    Several shapes are ambiguous: counted, none of them chosen. Codes without a member are left out;
    ``boundary_losses`` counts them. A NULL version is a version; NULL rings enclose nothing.
    """
    counted = boundaries.groupBy("code", "boundary_version").agg(
        F.count(F.lit(1)).alias("feature_count"), F.max("rings").alias("__rings")
    )
    one = F.col("feature_count") == 1
    placed = members.select(key, "code").join(counted, "code").withColumns(
        {
            "boundary_key": F.when(one, surrogate_key("BOUNDARY", F.col(key), F.col("boundary_version"))),
            "rings": F.when(one, F.col("__rings")),
            "publication_status": F.when(one, "PUBLISHED").otherwise("SKIPPED_AMBIGUOUS"),
        }
    ).drop("__rings")
    longitude, latitude = centroid(F.col("rings"))
    return placed.withColumns(
        {
            "geometry_valid_flag": F.when(one, longitude.isNotNull()),
            "centroid_longitude": longitude,
            "centroid_latitude": latitude,
        }
    )


def boundary_losses(dimension: DataFrame, boundaries: DataFrame) -> DataFrame:
    """One row: shapes given, published, skipped as ambiguous and skipped without a member; they add up."""
    published = F.col("publication_status") == "PUBLISHED"
    made = dimension.agg(
        F.count_if(published).alias("published"),
        F.coalesce(F.sum(F.when(~published, F.col("feature_count"))), F.lit(0)).alias("skipped_ambiguous"),
    )
    given = boundaries.agg(F.count(F.lit(1)).alias("shapes"))
    return made.transform(with_context, given).withColumn(
        "skipped_no_member", F.col("shapes") - F.col("published") - F.col("skipped_ambiguous")
    )


def status_dimension(observed: DataFrame, mapping: DataFrame, current_version: str) -> DataFrame:
    """Observed values and every approved rule version; only the current version stays active.

    ``observed`` has source_status; ``mapping`` has source_status, standardized_status,
    status_group and version.
    """
    ruled = mapping.select("source_status", "version", "standardized_status", "status_group")
    unruled = (
        observed.select("source_status").distinct()
        .join(ruled.filter(F.col("version") == current_version).select("source_status"), "source_status", "left_anti")
        .select(
            "source_status", F.lit(current_version).alias("version"),
            F.lit(None).cast("string").alias("standardized_status"),
            F.lit(None).cast("string").alias("status_group"),
        )
    )
    members = ruled.unionByName(unruled).withColumn("is_active", F.col("version") == current_version)
    return dimension(members, "status_key", "PROJECT_STATUS", ["source_status", "version"], {})


def project_dimension(entities: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Entities with a membership flag from a list that may repeat an entity."""
    flagged = listed.select(key).distinct().withColumn("__in", F.lit(True))
    return entities.join(flagged, key, "left").withColumn(
        "is_in_official_list", F.coalesce("__in", F.lit(False))
    ).drop("__in")


@dataclass(frozen=True)
class KeyRule:
    """How a fact row finds its member of one dimension.

    ``on`` pairs fact columns with the natural columns of ``dimension``. With ``valid`` (first day, day
    after the last) it is the version that holds on the fact's day ``at``. A row outside ``only`` or
    without a member gets key 0; with ``stop`` a row that has all natural values but no member ends the
    job instead. ``carry`` takes attributes of the member along, NULL beside key 0.
    """

    dimension: DataFrame
    key: str
    on: Mapping[str, str]
    only: Column | None = None
    valid: tuple[str, str] | None = None
    at: str | None = None
    carry: Mapping[str, str] = field(default_factory=dict)
    stop: bool = False


def with_key(fact: DataFrame, name: str, rule: KeyRule) -> DataFrame:
    """``fact`` with the key ``name`` and what the rule carries; never more or fewer rows, given unique members."""
    members = rule.dimension.filter(F.col(rule.key) != 0)
    take = {rule.key: "__key"} | {theirs: f"__c_{ours}" for theirs, ours in rule.carry.items()}
    if rule.valid:
        found = valid_version(fact, members, rule.on, rule.at, rule.valid, take)
    else:
        named = members.select(
            *[F.col(theirs).alias(f"__on_{i}") for i, theirs in enumerate(rule.on.values())],
            *[F.col(theirs).alias(ours) for theirs, ours in take.items()],
        )
        same = reduce(lambda x, y: x & y, [fact[ours] == named[f"__on_{i}"] for i, ours in enumerate(rule.on)])
        found = fact.join(named, same, "left").drop(*[f"__on_{i}" for i in range(len(rule.on))])
    usable = F.lit(True) if rule.only is None else F.coalesce(rule.only, F.lit(False))
    key = F.when(usable, F.col("__key"))
    if rule.stop:
        known = reduce(lambda x, y: x & y, [F.col(ours).isNotNull() for ours in rule.on])
        values = F.concat_ws(", ", *[F.col(ours).cast("string") for ours in rule.on])
        lost = F.raise_error(F.concat(F.lit(f"STOP: {name} has no active member for "), values)).cast("bigint")
        key = F.coalesce(key, F.when(usable & known, lost))
    carried = {ours: F.when(usable, F.col(f"__c_{ours}")) for ours in rule.carry.values()}
    return found.withColumns({name: F.coalesce(key, F.lit(0)), **carried}).drop(
        "__key", *[f"__c_{ours}" for ours in rule.carry.values()]
    )


def snapshot_fact(
    projects: DataFrame,
    rules: Mapping[str, KeyRule],
    snapshot_date: DataFrame,
    source: str,
    versions: Sequence[str] = (),
    long_running_months: int = 24,
) -> DataFrame:
    """One fact row per project with resolved dimension keys.

    ``rules`` maps a fact key to its rule; ``snapshot_date`` is one row with snapshot_date. The snapshot
    is known by ``source`` and that date. The project's own key is the one its dimension gives it, a hash
    of ``source`` and the contract, so it needs no join; snapshot key and run id are hashes of what
    they stand for, ``versions`` being the rule versions that took part.
    """
    fact = projects.withColumnRenamed("project_key", "contract_id").transform(with_context, snapshot_date)
    for name, rule in rules.items():
        fact = with_key(fact, name, rule)
    start, end, as_of = F.col("start_date"), F.col("completion_date"), F.col("snapshot_date")
    fact = fact.withColumns(
        {
            "project_key": surrogate_key("PROJECT", source, F.col("contract_id")),
            "source_snapshot_id": F.concat_ws("-", F.lit(source), F.date_format(as_of, "yyyyMMdd")),
            "snapshot_date_key": date_key(as_of),
            "start_date_key": date_key(start),
            "completion_date_key": date_key(end),
            "long_running_flag": spans_more_than(start, end, as_of, long_running_months),
            "zero_progress_flag": zero_progress(F.col("physical_progress_pct")),
            "is_current_snapshot": F.lit(True),
        }
    )
    return fact.withColumns(
        {
            "project_snapshot_key": surrogate_key("PROJECT_SNAPSHOT", F.col("project_key"), F.col("source_snapshot_id")),
            "run_id": run_id(F.col("source_snapshot_id"), *versions),
        }
    )


def fact_checks(
    fact: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    money: str,
    unique: str,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Row count, uniqueness of ``unique``, missing keys and money of a fact against its source.

    ``also`` are further aggregates of the fact, taken in the same pass.
    """
    made = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True)).alias("null_keys"),
        F.count_distinct(unique).alias("unique_rows"),
        F.sum(money).alias("fact_money"),
        *[value.alias(name) for name, value in (also or {}).items()],
    )
    given = source.agg(F.count(F.lit(1)).alias("source_rows"), F.sum(money).alias("source_money"))
    return made.transform(with_context, given).withColumn(
        "is_reconciled",
        (F.col("fact_rows") == F.col("source_rows"))
        & (F.col("unique_rows") == F.col("fact_rows"))
        & (F.col("null_keys") == 0)
        & F.col("fact_money").eqNullSafe(F.col("source_money")),
    )


def unmapped_statuses(projects: DataFrame, status_dim: DataFrame) -> DataFrame:
    """Non-NULL statuses without an active member: an error, never key 0."""
    active = status_dim.filter("is_active and status_key <> 0").select("source_status")
    return projects.filter("source_status is not null").select("source_status").distinct().join(
        active, "source_status", "left_anti"
    )


def orphan_dates(fact: DataFrame, keys: Sequence[str], calendar_dim: DataFrame) -> DataFrame:
    """Date keys of any role that the calendar does not hold, with their row count."""
    used = fact.select(F.explode(F.array(*keys)).alias("date_key")).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return used.join(calendar_dim.select("date_key"), "date_key", "left_anti")


def population_fact(population: DataFrame, members: DataFrame, code: str, key: str) -> DataFrame:
    """Population rows under their member key; unresolved population stays on key 0."""
    keyed = members.select(F.col(code).alias("__code"), key)
    joined = population.join(keyed, population[code].eqNullSafe(keyed["__code"]), "left").drop("__code")
    return joined.withColumn(key, F.coalesce(key, F.lit(0)))


def exposure_fact(grid: DataFrame, regions: DataFrame, levels: DataFrame) -> DataFrame:
    """Region x level exposure with both dimension keys; a missing member is key 0."""
    joined = grid.join(regions.select("region_code", "region_key"), "region_code", "left").join(
        levels.select("level", "level_key"), "level", "left"
    )
    return joined.withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("region_key", "level_key")}
    )


def snapshot_lineage(log: DataFrame, table: str) -> DataFrame:
    """The newest successful load of a table: snapshot id and the file date, never today."""
    done = log.filter((F.col("table_name") == table) & F.col("status").isin("SUCCESS", "SKIPPED_IDEMPOTENT"))
    newest = latest_per_key(done, ["table_name"], [F.col("completed_at"), F.col("run_id")])
    return newest.select(
        "table_name", "snapshot_id", F.col("source_modified_at").cast("date").alias("snapshot_date")
    )
