"""Join shapes of the reconciliation jobs (JOIN04-JOIN14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.operators.scale import latest_per_key, lookup


def two_sided(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Full outer comparison: both values, which side is missing, and whether they agree.

    Each side must hold a key once.
    """
    l = left.select(*keys, *[F.col(v).alias(f"{v}_left") for v in values], F.lit(True).alias("in_left"))
    r = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(v).alias(f"{v}_right") for v in values],
        F.lit(True).alias("in_right"),
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & l[key].eqNullSafe(r[f"__r_{key}"])
    joined = l.join(r, condition, "full_outer")
    same = F.lit(True)
    for value in values:
        same = same & F.col(f"{value}_left").eqNullSafe(F.col(f"{value}_right"))
    left_in, right_in = F.col("in_left").isNotNull(), F.col("in_right").isNotNull()
    return joined.select(
        *[F.when(left_in, F.col(k)).otherwise(F.col(f"__r_{k}")).alias(k) for k in keys],
        *[F.col(f"{v}_{side}") for v in values for side in ("left", "right")],
        F.when(~right_in, "ONLY_LEFT")
        .when(~left_in, "ONLY_RIGHT")
        .when(same, "SAME")
        .otherwise("DIFFERENT")
        .alias("comparison"),
    )


def complete_grid(
    members: DataFrame, classes: DataFrame, measures: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Every member with every class, measures where they exist.

    ``members`` and ``classes`` are dimension member lists; their product is the
    published grid itself.
    """
    return lookup(members.crossJoin(classes), measures, keys, "left")


def any_key_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], left_id: str, right_id: str
) -> DataFrame:
    """``a = x OR b = y`` as a union of equi joins, each pair once.

    An OR condition would force a nested loop. Only the two ids travel through the
    duplicate removal.
    """
    found = None
    for left_key, right_key in pairs:
        matched = left.select(F.col(left_id), F.col(left_key).alias("__key")).join(
            right.select(F.col(right_id), F.col(right_key).alias("__key")), "__key"
        )
        matched = matched.select(left_id, right_id)
        found = matched if found is None else found.unionByName(matched)
    return found.distinct()


def context_alias_join(
    rows: DataFrame,
    aliases: DataFrame,
    name: str,
    contexts: Mapping[str, str],
    row_key: str,
    target: str,
) -> DataFrame:
    """Alias lookup where a blank alias context is a wildcard and at least one context is named.

    ``contexts`` maps an alias context column to the row column it must equal. The
    aliases are split by which contexts they name; every split is an equi join.
    """
    alias_columns = list(contexts)
    found = None
    for mask in range(1, 2 ** len(alias_columns)):
        named = [c for i, c in enumerate(alias_columns) if mask >> i & 1]
        blank = [c for c in alias_columns if c not in named]
        chosen = F.lit(True)
        for column in named:
            chosen = chosen & (F.coalesce(F.trim(column), F.lit("")) != "")
        for column in blank:
            chosen = chosen & (F.coalesce(F.trim(column), F.lit("")) == "")
        part = aliases.filter(chosen).select(
            F.col(name).alias("__name"), *[F.col(c).alias(f"__{c}") for c in named], F.col(target)
        )
        condition = rows[name] == part["__name"]
        for column in named:
            condition = condition & (rows[contexts[column]] == part[f"__{column}"])
        matched = rows.join(part, condition).select(rows[row_key], part[target])
        found = matched if found is None else found.unionByName(matched)
    return found.distinct()


def latest_row_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], newest_by: Sequence[Column]
) -> DataFrame:
    """Left join to the newest right row per key."""
    return lookup(left, latest_per_key(right, keys, newest_by), keys, "left")
