"""Upserts as DataFrame plans: no table format is needed (SNK02-SNK05, SNK08, SNK09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verigrid.operators.scale import lookup


def _once(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source as it is; the job stops where a key repeats, which would multiply rows."""
    held = F.count(F.lit(1)).over(W.partitionBy(*keys))
    message = F.lit("a key occurs more than once in the source of an upsert")
    counted = source.withColumn("__held", held)
    return counted.filter(F.assert_true(F.col("__held") == 1, message).isNull()).drop("__held")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], allow_new_columns: bool = False) -> DataFrame:
    """Matched keys take the source row, new keys are added, other rows stay.

    A key that occurs twice in ``source`` stops the job. With ``allow_new_columns`` a column that only one side
    has is NULL on the other.
    """
    source = _once(source, keys)
    kept = lookup(target, source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=allow_new_columns)


def _both_sides(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.select(F.struct("*").alias("t"))
    s = _once(source, keys).select(F.struct("*").alias("s"))
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"t.{key}").eqNullSafe(F.col(f"s.{key}"))
    return t.join(s, condition, "full_outer")


def upsert_if_changed(
    target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Update a matched row only when a tracked column really differs, NULL-safe.

    An unchanged row keeps every old value, its update stamp included.
    """
    both = _both_sides(target, source, keys)
    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~F.col(f"t.{name}").eqNullSafe(F.col(f"s.{name}"))
    take_source = F.col("t").isNull() | (F.col("s").isNotNull() & changed)
    return both.select(
        *[F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    )


def snapshot_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], current: str, snapshot_day: str
) -> DataFrame:
    """Upsert a snapshot and retire current rows the source no longer holds, in one result.

    The job stops when the stored table already holds a newer snapshot.
    """
    stored = target.agg(F.max(snapshot_day)).scalar()
    given = source.agg(F.max(snapshot_day)).scalar()
    message = F.lit("the source holds an older snapshot than the stored table")
    newer = F.coalesce(given >= stored, F.lit(True))
    both = _both_sides(target, source, keys).filter(F.assert_true(newer, message).isNull())
    has_source = F.col("s").isNotNull()
    columns = [
        F.when(has_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        for c in target.columns
        if c != current
    ]
    flag = F.when(has_source, F.col(f"s.{current}")).otherwise(F.lit(False)).alias(current)
    return both.select(*columns, flag).select(*target.columns)


def retire_older_versions(df: DataFrame, version: str, current: Column) -> DataFrame:
    """Mark every row of another version inactive; nothing is deleted."""
    return df.withColumn(
        "is_active", F.col("is_active") & F.coalesce(F.col(version) == current, F.lit(False))
    )


def evolve(df: DataFrame, wanted: StructType, added: Sequence[str]) -> DataFrame:
    """Add the new columns of a schema once; all or none of them may be there already."""
    present = [name for name in added if name in df.columns]
    if present and len(present) != len(added):
        missing = sorted(set(added) - set(present))
        raise ValueError(f"partial schema: {missing} missing while {present} exist")
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in wanted
        ]
    )
