"""Window-shaped operators on tables that are already small: one row per dimension member.

Row-level windows live in ``verigrid.operators.scale``; the ones here see the
output of an aggregate, whose row count is the number of members, years or codes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """A percentage, NULL when the whole is 0 or missing; the value is rounded once."""
    whole = whole.cast("double")
    return F.round(F.when(whole != 0, 100 * part.cast("double") / whole), digits)


def per_unit(total: Column, units: Column, digits: int = 2) -> Column:
    """Money per unit in exact decimals, rounded half up; NULL for no units."""
    exact = total.cast("decimal(24,2)") / F.when(units != 0, units).cast("decimal(12,0)")
    return F.round(exact, digits).cast("double")


def concentration(df: DataFrame, partition: Sequence[str], value: str, tie: str) -> DataFrame:
    """Place, running total and cumulative share of members by falling value."""
    ordered = W.partitionBy(*partition).orderBy(F.col(value).desc_nulls_last(), F.col(tie))
    running = F.sum(value).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    total = F.sum(value).over(W.partitionBy(*partition))
    return df.withColumns(
        {
            "place": F.row_number().over(ordered).cast("bigint"),
            "cumulative_share_pct": F.when(F.col(value).isNotNull(), pct(running, total)),
        }
    )
