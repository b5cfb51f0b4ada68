"""Strict snapshot scans, lineage, row preservation and load decisions (SRC01, SRC02, SRC06-SRC10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from verigrid.plans.quality import Check, checks
from verigrid.sources.contracts import SourceContract
from verigrid.sources.records import contract_records, file_records, parse_records, records
from verigrid.operators.scale import with_context

COMPLETED = ("SUCCESS", "SKIPPED_IDEMPOTENT")


def scan_csv(spark: SparkSession, path: str, names: Sequence[str], contract: SourceContract) -> DataFrame:
    """All-string scan of CSV files with a header; files are split also where fields hold line breaks."""
    return parse_records(contract_records(spark, path, contract), names, contract.escape)


def scan_lines(spark: SparkSession, path: str, names: Sequence[str], line_sep: str = "\n") -> DataFrame:
    """One strict record per physical line, split at ``line_sep``; each file begins with the header."""
    return parse_records(records(spark, path, line_sep), names)


def header_lines(spark: SparkSession, path: str, names: Sequence[str], line_sep: str = "\n") -> DataFrame:
    """Line and header counts and the files without exactly one header, independent of the record parser."""
    return file_records(records(spark, path, line_sep), names)


def snapshot_identity(spark: SparkSession, path: str, contract: SourceContract) -> DataFrame:
    """One row naming the snapshot from file facts only; no file is opened.

    The listing columns of the binary source are read without its content column. The
    fingerprint of the file set does not depend on file order.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    facts = files.agg(
        F.min("path").alias("source_path"),
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("size_bytes"),
        F.max("modificationTime").alias("modified_at"),
        F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime"))).alias("files_mark"),
    )
    identity = F.sha2(
        F.concat_ws(
            "|", F.lit(contract.name), F.lit(contract.version), F.col("file_count").cast("string"),
            F.col("size_bytes").cast("string"), F.unix_micros("modified_at").cast("string"),
            F.col("files_mark").cast("string"),
        ),
        256,
    )
    return facts.withColumn("snapshot_id", identity)


def stamp_lineage(df: DataFrame, contract: SourceContract, identity: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    """Add the ten technical columns; the load time is a parameter, never the clock.

    File facts come from the one-row identity, because a parsed scan may have lost its
    file metadata.
    """
    one = identity.select(
        F.col("snapshot_id").alias("_source_snapshot_id"), F.col("size_bytes").alias("_source_file_size_bytes"),
        F.col("modified_at").alias("_source_modified_at"), F.col("source_path").alias("_source_path"),
        F.substring_index("source_path", "/", -1).alias("_source_file"),
    )
    stamped = df.transform(with_context, one)
    return stamped.withColumns(
        {
            "_source_system": F.lit(contract.system), "_source_name": F.lit(contract.name),
            "_source_version": F.lit(contract.version), "_ingest_run_id": F.lit(run_id),
            "_ingested_at": F.lit(ingested_at).cast("timestamp"),
        }
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, so the source is scanned once."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("parsed_rows")), watch


def reconcile_rows(written: DataFrame, parsed_rows: int, lines: DataFrame, table: str) -> DataFrame:
    """File records, parsed rows and written rows must be the same number, the header must occur once a file."""
    counts = written.agg(F.count(F.lit(1)).alias("written_rows")).transform(with_context, lines)
    records = F.max("lines") - F.max("header_lines")
    wrong = lambda ok: F.when(ok, 0).otherwise(1)
    return checks(
        counts, table,
        [
            Check("Completeness", "source has data rows", wrong(F.lit(parsed_rows > 0))),
            Check("Completeness", "written rows equal parsed rows", wrong(F.max("written_rows") == parsed_rows)),
            Check("Completeness", "parsed rows equal file records", wrong(records == parsed_rows)),
            Check("Validity", "header occurs once per file", wrong((F.max("header_lines") >= 1) & (F.max("header_faults") == 0))),
        ],
    )


def load_decision(audit: DataFrame, requested: DataFrame, identity: Sequence[str]) -> DataFrame:
    """What to do with each requested snapshot, judged by the audit log.

    Only a completed load claims a snapshot id; a STARTED or FAILED attempt never does.
    The first completed load is the claim: the same id with another file identity is a
    conflict, the same identity is skipped, an unclaimed id is loaded.
    """
    done = audit.filter(F.col("status").isin(*COMPLETED))
    when = F.struct(F.coalesce("completed_at", "started_at"), F.col("started_at"), F.col("run_id"))
    claims = done.groupBy("source_name", "snapshot_id").agg(
        F.min_by(F.struct(*[F.col(c) for c in identity], "run_id"), when).alias("claim"),
        F.max_by("rows_loaded", F.when(F.col("rows_loaded").isNotNull(), when)).alias("last_rows"),
    )
    joined = requested.join(claims, ["source_name", "snapshot_id"], "left")
    same = F.lit(True)
    for name in identity:
        same = same & F.col(name).eqNullSafe(F.col(f"claim.{name}"))
    decision = (
        F.when(F.col("claim").isNull(), "LOAD")
        .when(~same, "CONFLICT")
        .when(F.coalesce(F.col("last_rows"), F.lit(0)) <= 0, "LOAD")
        .otherwise("SKIPPED_IDEMPOTENT")
    )
    return joined.select("source_name", "snapshot_id", decision.alias("decision"), F.col("claim.run_id").alias("claimed_by"))


def table_state(df: DataFrame, lineage: Sequence[str]) -> DataFrame:
    """One-row identity summary of a landed table: rows, missing lineage, one identity or several."""
    broken = F.lit(False)
    for name in lineage:
        broken = broken | F.col(name).isNull()
    single = F.lit(True)
    for name in lineage:
        single = single & F.min(name).eqNullSafe(F.max(name))
    return df.agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count_if(broken).alias("identity_nulls"),
        single.alias("identity_is_single"), *[F.max(name).alias(name) for name in lineage],
    )
