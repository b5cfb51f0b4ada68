"""Building blocks that keep hot keys out of single tasks.

A plain window puts every row of a partition key into one task. The helpers here
give the same values through partial aggregates, joins that AQE can split, and
two-level scans over blocks, so a key that holds a third of all rows is still
worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.sinks.stage import materialize


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi join that keeps the left keys once."""
    if how in ("left_anti", "left_semi"):
        return left.join(right, null_safe_on(left, right, keys), how)
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"__r_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{key}" for key in keys])


def attach_group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """The values of ``agg() OVER (PARTITION BY keys)`` without a window.

    The aggregate combines map-side and yields one row per key; the join back is a
    hash or sort-merge join whose hot partitions AQE splits.
    """
    per_key = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in values.items()])
    return lookup(df, per_key, keys, "inner")


def with_context(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as a scalar subquery.

    The row is computed once and reaches the tasks as a literal; nothing is joined. A
    frame with more than one row stops the job.
    """
    row = one_row.select(F.struct("*")).scalar()
    return df.withColumns({name: row[name] for name in one_row.columns})


def attach_total(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """The values of ``agg() OVER ()`` from a one-row aggregate."""
    total = df.agg(*[expr.alias(name) for name, expr in values.items()])
    return df.transform(with_context, total)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[Column]) -> DataFrame:
    """``ROW_NUMBER() … = 1`` as a ``max_by`` aggregate, which combines map-side.

    ``newest_by`` must end in a tie-break. NULL sorts before every value, as in
    ``DESC NULLS LAST``.
    """
    others = [name for name in df.columns if name not in set(keys)]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*newest_by)).alias("__row")
    )
    return newest.select(*keys, *[F.col("__row")[name].alias(name) for name in others]).select(
        *df.columns
    )


def latest_batch(df: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """Every row of the newest batch per key, the ``DENSE_RANK … = 1`` set."""
    newest = df.groupBy(*keys).agg(F.max(batch).alias("__newest"))
    return lookup(df, newest, keys, "inner").filter(F.col(batch) == F.col("__newest")).drop(
        "__newest"
    )


def identical_row_ordinals(df: DataFrame, ordinal: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """Number identical rows 1..n within each set of equal rows.

    Equal rows are interchangeable, so counting them and writing the numbers out
    gives the same table as a window. A large set is cut into chunks that are
    spread over tasks before its rows are written out.
    """
    columns = df.columns
    size = F.lit(rows_per_task)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    chunks = counted.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / size)))
    )
    # a set that fits one chunk stays where the aggregate put it
    large = chunks.filter(F.col("__n") > size).repartition("__chunk", *columns)
    spread = chunks.filter(F.col("__n") <= size).unionByName(large)
    first = F.col("__chunk") * size + 1
    last = F.least(F.col("__n"), (F.col("__chunk") + 1) * size)
    return spread.withColumn(ordinal, F.explode(F.sequence(first, last))).drop("__n", "__chunk")


def _earlier_blocks(partition: Sequence[str]):
    """The blocks of a partition before the current one; a window over block summaries only."""
    parts = [F.col("__block")[name] for name in partition]
    return W.partitionBy(*parts).orderBy(F.col("__block")["b"]).rowsBetween(W.unboundedPreceding, -1)


def measured_blocks(df: DataFrame, partition: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with ``__block``, a struct of ``partition`` and the range ``b`` a row fell into.

    Ranges over (partition, order) are cut by Spark from a sample of the rows themselves and hold about
    equally many, so a partition with all rows has as many blocks as the session has shuffle partitions
    (fewer where adaptive execution joins small ones) and a small one has one or two. Rows equal in
    ``order`` share a block. The rows are written out once: ranges are sampled, and all readers have
    to see the same ones, also when an executor is lost.
    """
    ranged = df.repartitionByRange(*[F.col(name) for name in partition], *order)
    kept = materialize(ranged.withColumn("__range", F.spark_partition_id()), "scan-ranges")
    return kept.withColumn("__block", F.struct(*partition, F.col("__range").alias("b"))).drop("__range")


def running_values(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    block: Column | None,
    sums: Mapping[str, Column],
    strict: bool = False,
) -> DataFrame:
    """Running sums in ``order``, scanned in blocks.

    Without ``block`` the blocks are measured (``measured_blocks``); a given one must not
    decrease along ``order``. Each block is summed on its own, the few block sums are
    scanned, and rows add their block's opening value. A hot partition is therefore
    spread over as many tasks as it has blocks. ``strict`` leaves the current row out.
    """
    # one struct key: NULL parts compare equal, and the window and the join share its shuffle
    if block is None:
        blocked = measured_blocks(df, partition, order)
    else:
        blocked = df.withColumn("__block", F.struct(*partition, block.alias("b")))
    keys = ["__block"]
    block_sums = blocked.groupBy("__block").agg(
        *[F.sum(expr).alias(f"__s_{name}") for name, expr in sums.items()]
    )
    before = _earlier_blocks(partition)
    opening = block_sums.select(
        "__block", *[F.sum(f"__s_{name}").over(before).alias(f"__o_{name}") for name in sums]
    )
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(
        W.unboundedPreceding, -1 if strict else 0
    )
    scanned = blocked.withColumns(
        {f"__i_{name}": F.sum(expr).over(inside) for name, expr in sums.items()}
    )
    joined = scanned.join(opening, "__block")
    out = {
        name: F.when(
            F.col(f"__i_{name}").isNotNull() | F.col(f"__o_{name}").isNotNull(),
            F.coalesce(F.col(f"__i_{name}"), F.lit(0)) + F.coalesce(F.col(f"__o_{name}"), F.lit(0)),
        )
        for name in sums
    }
    return joined.withColumns(out).drop(
        "__block", *[f"__i_{n}" for n in sums], *[f"__o_{n}" for n in sums]
    )


def carry_forward(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    block_rows: int | None,
    values: Mapping[str, Column],
    strict: bool = False,
) -> DataFrame:
    """The last non-null value up to the current row, or strictly before it.

    Give a struct with a NULL field to carry a *reset*: the struct itself is not
    NULL, so it replaces what was carried before. ``order`` is unique per partition.
    Without ``block_rows`` the blocks are measured (``measured_blocks``); where ``order``
    is a dense row number, a block of ``block_rows`` numbers spares the written table.
    """
    if block_rows is None:
        blocked = measured_blocks(df, partition, [F.col(order)])
    else:
        block = F.floor(F.col(order) / block_rows).alias("b")
        blocked = df.withColumn("__block", F.struct(*partition, block))
    blocked = blocked.withColumns({f"__v_{name}": expr for name, expr in values.items()})
    keys = ["__block"]
    closing = blocked.groupBy("__block").agg(
        *[
            F.max_by(f"__v_{name}", F.when(F.col(f"__v_{name}").isNotNull(), F.col(order))).alias(
                f"__c_{name}"
            )
            for name in values
        ]
    )
    before = _earlier_blocks(partition)
    opening = closing.select(
        "__block",
        *[F.last(f"__c_{name}", ignorenulls=True).over(before).alias(f"__o_{name}") for name in values],
    )
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(
        W.unboundedPreceding, -1 if strict else 0
    )
    scanned = blocked.withColumns(
        {f"__l_{name}": F.last(f"__v_{name}", ignorenulls=True).over(inside) for name in values}
    )
    joined = scanned.join(opening, "__block")
    return joined.withColumns(
        {name: F.coalesce(f"__l_{name}", f"__o_{name}") for name in values}
    ).drop("__block", *[f"{p}{n}" for n in values for p in ("__v_", "__l_", "__o_")])


def rank_by_value(
    df: DataFrame,
    partition: Sequence[str],
    value: str,
    name: str,
    block: Column,
    eligible: Column | None = None,
) -> DataFrame:
    """``RANK() OVER (PARTITION BY … ORDER BY value DESC NULLS LAST)`` from counts.

    Rows are first reduced to one count per distinct value; the rank of a value is
    one plus the number of rows above it. ``block`` must not decrease as the value
    falls, with NULL values in the last block. Ineligible rows get no rank.
    """
    eligible = F.lit(True) if eligible is None else eligible
    marked = df.withColumn("__eligible", F.coalesce(eligible, F.lit(False)))
    keys = [*partition, "__eligible"]
    counts = marked.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_values(
        counts, keys, [F.col(value).desc_nulls_last()], block, {"__above": F.col("__n")}, strict=True
    ).select(*keys, value, (F.coalesce("__above", F.lit(0)) + 1).cast("bigint").alias(name))
    joined = lookup(marked, ranked, [*keys, value], "inner")
    return joined.withColumn(name, F.when(F.col("__eligible"), F.col(name))).drop("__eligible")
