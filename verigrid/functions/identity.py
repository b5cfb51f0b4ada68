"""Deterministic identities: row hashes, run ids, surrogate keys (FN09, FN10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(part) -> Column:
    return part if isinstance(part, Column) else F.lit(part)


def run_id(*parts, separator: str = "|") -> Column:
    """SHA-256 of snapshots, config versions and the rule version.

    A NULL part becomes an empty text, so two different inputs never share an id
    by dropping a part. No clock, UUID or random value takes part.
    """
    texts = [F.coalesce(as_column(part).cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws(separator, *texts), 256)


def row_hash(cols: Sequence[str]) -> Column:
    """Content hash of a row; a JSON object keeps NULL and '' apart."""
    return F.sha2(F.to_json(F.struct(*[F.col(name) for name in cols])), 256)


def text_hash(*parts, separator: str = "|") -> Column:
    """SHA-256 of parts joined with a separator, the Silver key convention."""
    return run_id(*parts, separator=separator)


def surrogate_key(label: str, *natural) -> Column:
    """BIGINT key of a dimension member: label plus natural key, never 0."""
    texts = [F.coalesce(as_column(part).cast("string"), F.lit("")) for part in natural]
    key = F.xxhash64(F.concat_ws("|", F.lit(label), *texts))
    return F.when(key == 0, F.lit(1).cast("bigint")).otherwise(key)
