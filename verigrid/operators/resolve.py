"""Conflict-aware aggregation: publish a value only when the group agrees (AGG05-AGG08, MAT17)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.operators.scale import with_context
from verigrid.sinks.stage import materialize


#: Rows of a bucket that ``differing_keys`` marks key by key when one of them differs.
BUCKET_ROWS = 128


def _status(lowest: Column, highest: Column, missing: str, resolved: Column | str) -> Column:
    resolved = F.lit(resolved) if isinstance(resolved, str) else resolved
    return (
        F.when(lowest.isNull(), missing).when(lowest.eqNullSafe(highest), resolved).otherwise("CONFLICT")
    )


def resolve_attributes(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Mapping[str, Column],
    money: Mapping[str, Column] | None = None,
    pairs: Mapping[str, Mapping[str, Column]] | None = None,
    missing: Mapping[str, str] | None = None,
    distinct_counts: bool = False,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key; every attribute as value plus ``<name>_resolution_status``.

    A group agrees exactly when the smallest and the largest value are equal, so the
    whole consolidation is one pass of map-side combined MIN and MAX, whatever the
    number of attributes. ``distinct_counts`` also publishes ``distinct_<name>_count``.

    ``money`` values are never summed: equal repeats resolve once. ``pairs`` resolve
    several columns as one unit, so they always come from one row; a pair counts only
    when all its columns are present.
    """
    money, pairs, missing = money or {}, pairs or {}, missing or {}
    units: dict[str, Column] = {**attributes, **money}
    for name, parts in pairs.items():
        present = F.lit(True)
        for expr in parts.values():
            present = present & expr.isNotNull()
        units[name] = F.when(present, F.struct(*[e.alias(n) for n, e in parts.items()]))
    aggregates = [F.count(F.lit(1)).alias("component_count")]
    for name, expr in units.items():
        aggregates += [F.min(expr).alias(f"__lo_{name}"), F.max(expr).alias(f"__hi_{name}")]
        if distinct_counts:
            aggregates.append(F.countDistinct(expr).alias(f"distinct_{name}_count"))
    aggregates += [F.count(expr).alias(f"valid_{name}_count") for name, expr in money.items()]
    aggregates += [expr.alias(name) for name, expr in (extra or {}).items()]
    grouped = df.groupBy(*keys).agg(*aggregates)

    out: list[Column] = [F.col(key) for key in keys] + [F.col("component_count")]
    for name in units:
        lowest, highest = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        agreed = lowest.eqNullSafe(highest)
        if name in pairs:
            out += [F.when(agreed, lowest[part]).alias(part) for part in pairs[name]]
        else:
            out.append(F.when(agreed, lowest).alias(name))
        resolved: Column | str = "RESOLVED"
        if name in money:
            resolved = F.when(F.col(f"valid_{name}_count") == 1, "RESOLVED_SINGLE").otherwise(
                "RESOLVED_REPEATED_IDENTICAL"
            )
            out.append(F.col(f"valid_{name}_count"))
        label = missing.get(name, "MISSING")
        out.append(_status(lowest, highest, label, resolved).alias(f"{name}_resolution_status"))
        if distinct_counts:
            out.append(F.col(f"distinct_{name}_count"))
    out += [F.col(name) for name in (extra or {})]
    return grouped.select(*out)


def union_of_arrays(df: DataFrame, keys: Sequence[str], arrays: Mapping[str, str]) -> DataFrame:
    """Sorted distinct union of array columns per key.

    The arrays are exploded and reduced to distinct values before they are
    collected, so a key with many rows ships its vocabulary, not its rows.
    """
    base = df.select(*keys).distinct()
    out = base
    for name, column in arrays.items():
        values = df.select(*keys, F.explode(column).alias("__v")).distinct()
        sets = values.groupBy(*keys).agg(F.array_sort(F.collect_list("__v")).alias(name))
        out = out.join(sets, list(keys), "left").withColumn(
            name, F.coalesce(name, F.array().cast(f"array<{values.schema['__v'].dataType.simpleString()}>"))
        )
    return out


def row_text(cols: Sequence[Column]) -> Column:
    """A row as one text: each value behind its length, so no two rows read the same; NULL is '-'."""
    texts = [c.cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def multiset_mark(cols: Sequence[Column]) -> list[Column]:
    """Order-independent mark of a bag of rows: their number and two sums of 60-bit row hashes.

    Sums keep what an exclusive or loses: equal rows do not cancel each other. They combine
    map-side and over parts of a table. A hash is added up as three numbers of 20 bits, so the
    sums are plain longs that last for 2^43 rows; only the totals are decimals.
    """
    return _mark_sums(*_row_numbers(cols))


def _row_numbers(cols: Sequence[Column]) -> list[Column]:
    """The first 120 bits of a row's hash as two numbers."""
    digest = F.md5(row_text(cols))
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 16)]


def _mark_sums(low: Column, high: Column) -> list[Column]:
    def total(number: Column) -> Column:
        sums = [F.sum(F.shiftright(number, shift).bitwiseAND(F.lit((1 << 20) - 1))) for shift in (40, 20, 0)]
        top, middle, rest = (part.cast("decimal(20,0)") for part in sums)
        return (top * F.lit(1 << 40).cast("decimal(13,0)") + middle * F.lit(1 << 20).cast("decimal(7,0)") + rest).cast("decimal(38,0)")

    return [F.count(F.lit(1)).alias("mark_rows"), total(low).alias("mark_low"), total(high).alias("mark_high")]


def multiset_marks(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``multiset_mark`` of each group; a row's hash is a column of its own, so it is computed once."""
    low, high = _row_numbers([F.col(c) for c in cols])
    rows = df.withColumns({"__low": low, "__high": high}).select(*by, "__low", "__high")
    return rows.groupBy(*by).agg(*_mark_sums(F.col("__low"), F.col("__high")))


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int = 4096) -> DataFrame:
    """The keys whose bags of rows differ, with their number of rows on either side.

    A tree of marks: bucket marks are compared first, and only the rows of buckets that differ are
    marked key by key. Two equal tables cost one small aggregate each. There are at least ``buckets``
    of them, and more for larger tables: a differing key brings about as many rows along at any size.
    """
    buckets = max(buckets, left.count() // BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")
    every = [*keys, *cols]
    marks = ["mark_rows", "mark_low", "mark_high"]

    def met(one: DataFrame, two: DataFrame, by: Sequence[str]) -> DataFrame:
        sides = [multiset_marks(df, by, every).withColumnsRenamed({m: f"{m}_{n}" for m in marks}) for n, df in ((1, one), (2, two))]
        on = sides[0].join(sides[1].withColumnsRenamed({k: f"__{k}" for k in by}), null_safe([sides[0][k].eqNullSafe(F.col(f"__{k}")) for k in by]), "full_outer")
        same = null_safe([F.col(f"{m}_1").eqNullSafe(F.col(f"{m}_2")) for m in marks])
        found = on.filter(~same)
        return found.select(
            *[F.when(F.col("mark_rows_1").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in by],
            *[F.coalesce(f"mark_rows_{n}", F.lit(0)).alias(name) for n, name in ((1, "left_rows"), (2, "right_rows"))],
        )

    one, two = (df.select(*keys, *cols).withColumn("bucket", bucket) for df in (left, right))
    # written, so that its size is known: a short list is sent to the rows, which then stay where they are
    broken = materialize(met(one, two, ["bucket"]).select("bucket"), "broken-buckets")
    return met(one.join(broken, "bucket", "left_semi"), two.join(broken, "bucket", "left_semi"), list(keys))


def null_safe(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def distinct_text(col: Column, separator: str = "; ") -> Column:
    """Distinct reasons or codes as one sorted text; ``col`` holds a controlled vocabulary."""
    return F.concat_ws(separator, F.sort_array(F.collect_set(col)))


def accounting(df: DataFrame, buckets: Mapping[str, Column], audited: DataFrame) -> DataFrame:
    """Count mutually exclusive buckets in one pass and reconcile them with an audited row count.

    ``audited`` is one row with the column ``audited_rows``.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(cond).alias(name) for name, cond in buckets.items()],
    )
    total = sum((F.col(name) for name in buckets), F.lit(0))
    return counts.transform(with_context, audited).withColumn(
        "is_reconciled",
        (F.col("total_rows") == total) & (F.col("total_rows") == F.col("audited_rows")),
    )
