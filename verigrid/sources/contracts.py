"""Source contracts, header rules and the precheck inventory (SRC03-SRC05, SRC12, SRC15)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The technical columns every landed row carries.
LINEAGE_COLUMNS = (
    "_source_system", "_source_name", "_source_file", "_source_path", "_source_file_size_bytes",
    "_source_modified_at", "_source_version", "_source_snapshot_id", "_ingest_run_id", "_ingested_at",
)


class ContractError(ValueError):
    """A source breaks its contract; nothing was written."""


@dataclass(frozen=True)
class SourceContract:
    """What one source must look like; ``groups`` lists the accepted aliases of each required column."""

    name: str
    table: str
    groups: Mapping[str, Sequence[str]]
    system: str = "public_records"
    version: str = ""
    multi_line: bool = False
    escape: str = '"'
    line_sep: str = "\n"
    expected_rows: int | None = None
    reserved: Sequence[str] = field(default=LINEAGE_COLUMNS)


def safe_names(header: Sequence[str], reserved: Sequence[str] = LINEAGE_COLUMNS) -> tuple[list[str], dict[str, str]]:
    """Storable column names with the old-to-new map; collisions and reserved names fail."""
    names = [re.sub(r"[ ,;{}()\n\t=]+", "_", name.strip()) for name in header]
    seen: dict[str, str] = {}
    for old, new in zip(header, names):
        key = new.casefold()
        if not new:
            raise ContractError(f"column {old!r} has no usable name")
        if key in {r.casefold() for r in reserved}:
            raise ContractError(f"column {old!r} uses a reserved name")
        if key in seen:
            raise ContractError(f"columns {seen[key]!r} and {old!r} both become {new!r}")
        seen[key] = old
    return names, dict(zip(header, names))


def missing_groups(contract: SourceContract, columns: Sequence[str]) -> list[str]:
    """Required column groups without any alias in the header, case-insensitive."""
    present = {name.casefold() for name in columns}
    return [
        group for group, aliases in contract.groups.items() if not any(a.casefold() in present for a in aliases)
    ]


def require_header(contract: SourceContract, columns: Sequence[str]) -> None:
    missing = missing_groups(contract, columns)
    if missing:
        raise ContractError(f"{contract.name}: no column for {', '.join(missing)}")


def header_drift(spark: SparkSession, current: Sequence[str], incoming: Sequence[str]) -> DataFrame:
    """Added and removed columns against the current table; a report, never a gate."""
    rows = [(c, "ADDED") for c in incoming if c not in set(current)]
    rows += [(c, "REMOVED") for c in current if c not in set(incoming)]
    return spark.createDataFrame(rows, "column_name string, drift string")


def precheck(df: DataFrame, contract: SourceContract) -> DataFrame:
    """One status row for a source; the union over sources shows all failures together."""
    missing = missing_groups(contract, df.columns)
    expected = F.lit(contract.expected_rows).cast("bigint")
    count = F.count(F.lit(1))
    return df.agg(
        F.lit(contract.name).alias("source_name"), count.alias("row_count"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        F.when(F.lit(bool(missing)), "MISSING_COLUMNS").when(count == 0, "EMPTY")
        .when(expected.isNotNull() & (count != expected), "UNEXPECTED_ROW_COUNT")
        .otherwise("READY").alias("precheck_status"),
    )
