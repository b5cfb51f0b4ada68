"""Governed, versioned mappings (MAP01-MAP06, MAT20)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.sinks.stage import materialize

from verigrid.operators.scale import lookup

APPROVED = "APPROVED"


def may_act() -> Column:
    """Only approved and active configuration rows may act."""
    return (F.col("approval_status") == APPROVED) & F.coalesce(F.col("is_active"), F.lit(False))


def mapping_state(config: DataFrame, version: str, keys: Sequence[str]) -> DataFrame:
    """One row: how many versions may act, and whether a key would fan out."""
    acting = config.filter(may_act())
    counted = acting.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(version).alias("lo"), F.max(version).alias("hi")
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("active_rows"),
        F.count_if(F.col("n") > 1).alias("fan_out_keys"),
        F.min("lo").alias("lowest_version"),
        F.max("hi").alias("highest_version"),
    )
    state = (
        F.when(F.col("active_rows") == 0, "NO_ACTIVE_VERSION")
        .when(F.col("lowest_version") != F.col("highest_version"), "MANY_ACTIVE_VERSIONS")
        .when(F.col("fan_out_keys") > 0, "FAN_OUT_KEY")
        .otherwise("OK")
    )
    return counted.withColumn("mapping_state", state)


def active_mapping(config: DataFrame, version: str, keys: Sequence[str]) -> DataFrame:
    """The rows of the single acting version; the job stops when there is none, or several.

    The check is part of the plan, so the gate runs with the query that uses the mapping.
    """
    state = mapping_state(config, version, keys).select("mapping_state").scalar()
    message = F.concat(F.lit("mapping cannot act: "), state)
    return config.filter(may_act()).filter(F.assert_true(state == "OK", message).isNull())


def apply_mapping(df: DataFrame, mapping: DataFrame, on: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """Left join a 1:1 mapping and say whether each row is mapped; rows never multiply.

    ``on`` maps the data column to the mapping column. The mapping must have passed
    ``active_mapping``, which proves its keys are unique.
    """
    right = mapping.select(
        *[F.col(column).alias(f"__m_{column}") for column in on.values()],
        *take,
        F.lit(True).alias("__hit"),
    )
    condition = F.lit(True)
    for data_column, column in on.items():
        condition = condition & (df[data_column] == right[f"__m_{column}"])
    joined = df.join(right, condition, "left")
    state = F.when(F.col("__hit"), "MAPPED").otherwise("UNMAPPED")
    return joined.withColumn("mapping_state", state).drop(
        "__hit", *[f"__m_{column}" for column in on.values()]
    )


def classify_tokens(
    df: DataFrame,
    tokens: str,
    mapping: DataFrame,
    token: str = "token",
    sector: str = "sector",
    flag: str = "is_flagged",
    many: str = "Multi-sector",
) -> DataFrame:
    """Classify a token list: one approved token gives its sector, several give ``many``.

    An empty list or any unapproved token gives NULL sector and NULL flag with the
    reason. Lists repeat, so each distinct list is classified once and joined back;
    the explode never touches the full table.
    """
    lists = df.select(tokens).distinct()
    pieces = lists.withColumn("__token", F.explode(tokens))
    approved = mapping.select(
        F.col(token).alias("__token"), F.col(sector).alias("__sector"), F.col(flag).alias("__flag"),
        F.lit(True).alias("__approved"),
    )
    judged = (
        pieces.join(approved, "__token", "left")
        .groupBy(tokens)
        .agg(
            F.count(F.lit(1)).alias("token_count"),
            F.count("__approved").alias("approved_count"),
            F.array_sort(F.collect_set("__sector")).alias("approved_sectors"),
            F.array_sort(
                F.collect_set(F.when(F.col("__approved").isNull(), F.col("__token")))
            ).alias("unapproved_tokens"),
            F.coalesce(F.bool_or("__flag"), F.lit(False)).alias("__any_flag"),
        )
    )
    empty = F.col("token_count").isNull()
    gap = F.col("approved_count") != F.col("token_count")
    single = F.col("token_count") == 1
    classified = lists.join(judged, tokens, "left").select(
        tokens,
        F.when(empty | gap, None).when(single, F.element_at("approved_sectors", 1)).otherwise(many).alias(
            "standardized_sector"
        ),
        F.when(~(empty | gap), F.col("__any_flag")).alias(flag),
        F.when(empty | gap, "UNMAPPED").otherwise("MAPPED").alias("category_mapping_state"),
        F.when(empty, "MISSING_SOURCE_CATEGORY")
        .when(gap, "UNAPPROVED_SOURCE_CATEGORY")
        .when(single, "MAPPED_SINGLE")
        .otherwise("MAPPED_MULTI")
        .alias("category_classification_status"),
        F.coalesce("unapproved_tokens", F.array().cast("array<string>")).alias("unapproved_tokens"),
    )
    return lookup(df, classified, [tokens])


def mapping_coverage(
    raw: DataFrame, config: DataFrame, domain: str, value: str, config_value: str, version: str
) -> DataFrame:
    """Distinct raw values with their row weight, review state and readiness.

    Only an approved and active rule makes a value READY; an active rule still in
    review shows its own state.
    """
    counted = raw.groupBy(F.coalesce(F.trim(value), F.lit("")).alias("raw_value")).agg(
        F.count(F.lit(1)).alias("source_rows")
    )
    active = config.filter("is_active").select(
        F.col(config_value).alias("__value"), "approval_status", F.col(version).alias("mapping_version")
    )
    joined = counted.join(active, F.col("raw_value") == F.col("__value"), "left")
    return joined.select(
        F.lit(domain).alias("mapping_domain"),
        "raw_value",
        "source_rows",
        F.coalesce("approval_status", F.lit("UNMAPPED")).alias("review_state"),
        "mapping_version",
        F.when(F.col("approval_status") == APPROVED, "READY").otherwise("REVIEW_REQUIRED").alias(
            "coverage_status"
        ),
    )


def mapping_inventory(configs: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per mapping table: rows, acting rows, rows in review, newest version."""
    out = None
    for name, (config, version) in configs.items():
        part = config.agg(
            F.lit(name).alias("mapping_table"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(may_act()).alias("active_approved_rows"),
            F.count_if(F.col("approval_status") == "PENDING_REVIEW").alias("pending_rows"),
            F.max(version).alias("newest_version"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def publish_status(
    df: DataFrame, keys: Sequence[str], raw: Column, mapped: Mapping[str, Column]
) -> DataFrame:
    """Publish a mapped status only when the raw status resolves and every mapping agrees.

    Only rows that report a raw status count. A group with two raw statuses, or with
    one raw status mapped two ways or not at all, stays UNMAPPED.
    """
    text = F.when(F.trim(raw) != "", F.trim(raw))
    units = {f"__u_{name}": expr for name, expr in mapped.items()}
    reports = df.withColumns({"__text": text, **units}).select(*keys, "__text", *units)
    told = reports.filter("__text IS NOT NULL")
    # ids are given once and written, so that both readers see the same
    kinds = told.select("__text", *units).distinct().withColumn("__kind", F.monotonically_increasing_id())
    kinds = materialize(kinds, "status-kinds")
    named = kinds.withColumnsRenamed({name: f"__k{name}" for name in ("__text", *units)})
    same = F.lit(True)
    for name in ("__text", *units):
        same = same & F.col(name).eqNullSafe(F.col(f"__k{name}"))
    # longs are added up by hash; texts and structs would make every task sort its rows
    grouped = reports.join(named, same, "left").groupBy(*keys).agg(F.min("__kind").alias("__lo"), F.max("__kind").alias("__hi"))
    complete = F.lit(True)
    for name in units:
        complete = complete & F.col(name).isNotNull()
    agreed = kinds.filter(complete).select(F.col("__kind").alias("__one"), *units)
    published = grouped.join(agreed, (F.col("__lo") == F.col("__hi")) & (F.col("__lo") == F.col("__one")), "left")
    return published.select(
        *keys,
        *[F.col(f"__u_{name}").alias(name) for name in mapped],
        F.when(F.col("__one").isNotNull(), "MAPPED").otherwise("UNMAPPED").alias("status_mapping_state"),
    )
