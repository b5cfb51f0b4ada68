"""One loader for every contract: a claim, ordered audit events, a checked publish (SRC09, SRC10, SRC15)."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.sinks import publish as sink
from verigrid.sources import contracts, snapshot
from verigrid.sources.records import contract_records, file_records, parse_records

# The columns of the audit log.
AUDIT_SCHEMA = (
    "run_id string, source_name string, table_name string, snapshot_id string, source_path string, source_format string, "
    "source_size_bytes bigint, source_modified_at timestamp, source_version string, rows_loaded bigint, status string, "
    "started_at timestamp, completed_at timestamp, error_message string, column_mapping_json string"
)
#: What a snapshot id stands for; the same id with other values is a conflict.
IDENTITY = ["source_path", "source_size_bytes", "source_modified_at", "source_version"]


class SnapshotConflict(RuntimeError):
    """A snapshot id is taken by other files, or another loader is at work on it."""


class Claim:
    """Write-once mark of the one loader that works on a snapshot: a file that only its maker could create.

    It goes with the end of the load. A loader that died leaves its mark; ``take_over`` names the
    run that is known to be dead.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, snapshot_id: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path(f"{root}/_claims/{source}/{snapshot_id}")
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = jvm

    def holder(self) -> str | None:
        if not self.files.exists(self.path):
            return None
        stream = self.files.open(self.path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def take(self, run_id: str, take_over: str | None = None) -> None:
        if take_over is not None and self.holder() == take_over:
            self.files.delete(self.path, False)
        self.files.mkdirs(self.path.getParent())
        try:
            stream = self.files.create(self.path, False)  # fails where the file exists
        except Exception as error:
            if not self.files.exists(self.path):
                raise
            raise SnapshotConflict(f"run {self.holder()} is loading {self.path.getName()}") from error
        stream.write(bytearray(run_id.encode()))
        stream.close()

    def release(self) -> None:
        self.files.delete(self.path, False)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """The audit log; an empty one where nothing was loaded yet."""
    try:
        return spark.read.schema(AUDIT_SCHEMA).parquet(f"{root}/_audit")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], AUDIT_SCHEMA)


def published_rows(spark: SparkSession, root: str, table: str, snapshot_id: str) -> int | None:
    """Rows of the published table if it holds this snapshot, whole and with one lineage; else None."""
    if sink.read_pointer(spark, root, table) is None:
        return None
    state = snapshot.table_state(sink.read_published(spark, root, table), ["_source_snapshot_id", "_source_path", "_ingest_run_id"]).first()
    good = state["identity_nulls"] == 0 and state["identity_is_single"] and state["_source_snapshot_id"] == snapshot_id
    return state["rows_loaded"] if good else None


def load(
    spark: SparkSession, path: str, names: Sequence[str], contract: contracts.SourceContract, root: str, run_id: str,
    snapshot_id: str | None = None, now: Callable[[], dt.datetime] | None = None, take_over: str | None = None,
) -> tuple[str, int]:
    """Land one snapshot under ``root`` and tell (status, rows).

    The status is SUCCESS, or SKIPPED_IDEMPOTENT where the audit log has the same files under the
    snapshot id and the published table still holds them; then nothing is read. Each load appends its
    events: STARTED, then SUCCESS or FAILED with the error's text; or SKIPPED_IDEMPOTENT; or, where
    the id stands for other files or another loader is at work, FAILED alone and SnapshotConflict is raised. Rows are
    written to a folder of the attempt, counted by the write, checked against the file's records and
    only then published, so a failed load leaves the published table as it was. ``snapshot_id``
    defaults to the identity of the files, ``now`` to the clock in UTC.
    """
    now = now or (lambda: dt.datetime.now(dt.timezone.utc))
    started = now()
    facts = snapshot.snapshot_identity(spark, path, contract).first()
    snapshot_id = snapshot_id or facts["snapshot_id"]
    columns, mapping = list(names), {}
    event = {
        "run_id": run_id, "source_name": contract.name, "table_name": contract.table, "snapshot_id": snapshot_id,
        "source_path": facts["source_path"], "source_format": "csv", "source_size_bytes": facts["size_bytes"],
        "source_modified_at": facts["modified_at"], "source_version": contract.version, "started_at": started,
    }

    def note(status: str, rows: int | None = None, error: str | None = None) -> None:
        done = None if status == "STARTED" else now()
        row = event | {"status": status, "rows_loaded": rows, "completed_at": done, "error_message": error, "column_mapping_json": json.dumps(mapping)}
        order = [field.split()[0] for field in AUDIT_SCHEMA.split(", ")]
        sink.append(sink.one_row(spark, AUDIT_SCHEMA, *[row.get(c) for c in order]), f"{root}/_audit")

    wanted = "source_name string, snapshot_id string, source_path string, source_size_bytes bigint, source_modified_at timestamp, source_version string"
    requested = sink.one_row(spark, wanted, *[event[c] for c in ("source_name", "snapshot_id", *IDENTITY)])
    decision = snapshot.load_decision(read_audit(spark, root), requested, IDENTITY).first()
    claim = Claim(spark, root, contract.name, snapshot_id)
    try:
        if decision["decision"] == "CONFLICT":
            raise SnapshotConflict(f"snapshot {snapshot_id} of {contract.name} was loaded from other files by run {decision['claimed_by']}")
        if decision["decision"] == "SKIPPED_IDEMPOTENT" and (rows := published_rows(spark, root, contract.table, snapshot_id)):
            note("SKIPPED_IDEMPOTENT", rows)
            return "SKIPPED_IDEMPOTENT", rows
        claim.take(run_id, take_over)
    except SnapshotConflict as error:
        note("FAILED", error=str(error)[:2000])
        raise
    try:
        columns, mapping = contracts.safe_names(names)
        note("STARTED")
        contracts.require_header(contract, columns)
        found = contract_records(spark, path, contract)
        scan = parse_records(found, names, contract.escape).toDF(*columns)
        kinds = "source_path string, size_bytes bigint, modified_at timestamp, snapshot_id string"
        identity = sink.one_row(spark, kinds, *[facts[c] for c in ("source_path", "size_bytes", "modified_at")], snapshot_id)
        stamped = snapshot.stamp_lineage(scan, contract, identity, run_id, started.strftime("%Y-%m-%d %H:%M:%S"))
        counted, watch = snapshot.observed(stamped, f"load {contract.name} {run_id}")
        lines = file_records(found, names)
        rules = lambda written: snapshot.reconcile_rows(written, watch.get["parsed_rows"], lines, contract.table)
        sink.publish(counted, root, contract.table, run_id, rules)
        rows = watch.get["parsed_rows"]  # the checks found as many rows written
        note("SUCCESS", rows)
        return "SUCCESS", rows
    except Exception as error:
        note("FAILED", error=str(error).strip()[:2000])
        raise
    finally:
        claim.release()
