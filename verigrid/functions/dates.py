"""Date keys and delivery rules (FN07, FCT05, FCT06)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd INT; the unknown day is 0."""
    return F.coalesce(F.date_format(day, "yyyyMMdd").cast("int"), F.lit(0))


def spans_more_than(start: Column, end: Column, as_of: Column, months: int) -> Column:
    """True when the period runs longer than ``months``, capped at ``as_of``.

    NULL without a start and when the end is before the start: the rule cannot be judged.
    """
    capped = F.least(F.coalesce(end, as_of), as_of)
    return F.when(
        start.isNotNull() & ~F.coalesce(end < start, F.lit(False)),
        F.add_months(start, months) < capped,
    )


def zero_progress(progress: Column) -> Column:
    """True only for a published progress of exactly 0; NULL stays NULL."""
    return F.when(progress.isNotNull(), progress == 0)
