"""Members that are valid for a time: the version of a natural key on a day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.operators.scale import with_context


def valid_version(
    rows: DataFrame,
    members: DataFrame,
    on: Mapping[str, str],
    at: str,
    valid: tuple[str, str],
    take: Mapping[str, str],
    bucket_days: int = 366,
) -> DataFrame:
    """Every row with ``take`` of the member version that holds on its day ``at``, else NULL.

    ``on`` pairs columns of ``rows`` with columns of ``members``, ``valid`` names the first day of a
    version and the day after its last one (NULL is open, an empty interval never holds), ``take`` maps
    a column of ``members`` to its new name. Versions are laid out over buckets of days and meet rows in
    their bucket, so a row is compared with the versions of that time and not with a member's whole
    history. Days before or after all borders share the outermost bucket, so open versions need no more
    buckets than the history has. A NULL day or natural value finds nothing. Versions of one member must
    not overlap (``overlapping_versions``).
    """
    first, end = F.col("__first"), F.col("__end")
    bucket = lambda day: F.floor(F.unix_date(day) / bucket_days)
    kept = members.select(
        *[F.col(theirs).alias(f"__on_{i}") for i, theirs in enumerate(on.values())],
        F.col(valid[0]).alias("__first"), F.col(valid[1]).alias("__end"),
        *[F.col(name).alias(new) for name, new in take.items()],
    ).filter(F.coalesce(first < end, F.lit(True)))
    last = F.date_sub(end, 1)
    reach = kept.agg(
        F.coalesce(F.least(F.min(bucket(first)), F.min(bucket(last))), F.lit(0)).alias("__low"),
        F.coalesce(F.greatest(F.max(bucket(first)), F.max(bucket(last))), F.lit(0)).alias("__high"),
    )
    low, high = F.col("__low"), F.col("__high")
    spread = kept.transform(with_context, reach).withColumn(
        "__bucket_of", F.explode(F.sequence(F.coalesce(bucket(first), low), F.coalesce(bucket(last), high)))
    ).drop("__low", "__high")
    asked = rows.transform(with_context, reach).withColumn(
        "__bucket", F.least(F.greatest(bucket(F.col(at)), low), high)
    )
    holds = (F.col("__bucket") == F.col("__bucket_of")) & F.col(at).isNotNull()
    for i, ours in enumerate(on):
        holds = holds & (asked[ours] == F.col(f"__on_{i}"))
    holds = holds & F.coalesce(first <= F.col(at), F.lit(True)) & F.coalesce(F.col(at) < end, F.lit(True))
    return asked.join(spread, holds, "left").select(*[f"`{c}`" for c in rows.columns], *take.values())


def overlapping_versions(members: DataFrame, natural: Sequence[str], valid: tuple[str, str]) -> DataFrame:
    """Versions that begin before an earlier one of the same member has ended; empty intervals do not count.

    The window holds the versions of one member.
    """
    first, end = F.col(valid[0]), F.col(valid[1])
    opens, closes = F.coalesce(first, F.lit("0001-01-01").cast("date")), F.coalesce(end, F.lit("9999-12-31").cast("date"))
    earlier = W.partitionBy(*natural).orderBy(opens, closes).rowsBetween(W.unboundedPreceding, -1)
    held = members.filter(F.coalesce(first < end, F.lit(True)))
    return held.withColumn("__until", F.max(closes).over(earlier)).filter(opens < F.col("__until")).drop("__until")
