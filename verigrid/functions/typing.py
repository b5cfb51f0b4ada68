"""Safe typing with quality statuses (PRJ01-PRJ04, PRJ07, PRJ08)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    """A blank or whitespace-only text is missing."""
    trimmed = F.trim(col)
    return F.when(trimmed != "", trimmed)


def typed(
    raw: Column,
    data_type: str,
    lo: float | None = None,
    hi: float | None = None,
    below: str = "OUT_OF_RANGE",
) -> tuple[Column, Column]:
    """Parse ``raw`` and say how good it is; the caller keeps ``raw`` beside both.

    The value stays published when it is out of range, so the status is the only
    gate. ``below`` names the status of a value under ``lo`` (money uses NEGATIVE).
    """
    text = blank_to_null(raw)
    value = text.try_cast(data_type)
    status = F.when(text.isNull(), "MISSING").when(value.isNull(), "UNPARSEABLE")
    if lo is not None:
        status = status.when(value < F.lit(lo), below)
    if hi is not None:
        status = status.when(value > F.lit(hi), "OUT_OF_RANGE")
    return value, status.otherwise("VALID")


def coordinate_status(
    latitude: Column,
    longitude: Column,
    screen: tuple[float, float, float, float],
    raw: tuple[Column, Column] | None = None,
) -> Column:
    """Status of a coordinate *pair*; ``screen`` is (min_lat, max_lat, min_lon, max_lon), inclusive.

    With ``raw`` given, a raw value that does not parse is UNPARSEABLE rather than missing.
    """
    present_lat, present_lon = raw if raw else (latitude, longitude)
    min_lat, max_lat, min_lon, max_lon = screen
    return (
        F.when(present_lat.isNull() & present_lon.isNull(), "MISSING_PAIR")
        .when(present_lat.isNull() | present_lon.isNull(), "PARTIAL_PAIR")
        .when(latitude.isNull() | longitude.isNull(), "UNPARSEABLE")
        .when(
            ~latitude.between(min_lat, max_lat) | ~longitude.between(min_lon, max_lon),
            "OUT_OF_RANGE",
        )
        .otherwise("VALID_PAIR")
    )


def decode(code: Column, labels: Mapping[str, str], otherwise: str) -> Column:
    """Code table lookup with an explicit label for codes outside the table."""
    table = F.create_map(*[F.lit(part) for part in chain.from_iterable(labels.items())])
    return F.coalesce(table[code], F.lit(otherwise))


def publish_if_single(value: Column, count: Column) -> Column:
    """The value when exactly one distinct value exists, otherwise NULL."""
    return F.when(count == 1, value)


def parent_code(code: Column, keep: int, width: int) -> Column:
    """The ancestor code that shares the first ``keep`` digits of a fixed-width code."""
    return F.rpad(F.substring(code, 1, keep), width, "0")


def whole_number_text(text: Column) -> Column:
    """The leading number of a cell such as '92,337,852 a' or '1.18E7', commas removed."""
    found = F.regexp_extract(F.trim(text), r"^-?[0-9,]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?", 0)
    return F.when(found != "", F.regexp_replace(found, ",", ""))


def to_number(text: Column) -> Column:
    """Tolerant number parse; NULL when the text does not start with a number."""
    return whole_number_text(text).try_cast("double")


def to_count(text: Column) -> Column:
    """Tolerant whole-count parse; NULL for a number with a fraction."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def columns_text(cols: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in cols]
