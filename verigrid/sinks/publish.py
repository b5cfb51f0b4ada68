"""Publish tables idempotently: stage, check, then move a pointer (SNK01, SNK06, SNK07, SNK10, SRC11)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from verigrid.plans.quality import gate

POINTER_SCHEMA = "table_name string, run_id string, row_count bigint, published_seq bigint, attempt string"


def one_row(spark: SparkSession, schema: str, *values) -> DataFrame:
    """A row of literals in one partition; no Python worker is asked for it."""
    fields = [field.split() for field in schema.split(", ")]
    columns = [F.lit(value).cast(kind).alias(name) for (name, kind), value in zip(fields, values, strict=True)]
    return spark.range(0, 1, 1, 1).select(*columns)


def run_path(root: str, table: str, run_id: str, attempt: str) -> str:
    return f"{root}/{table}/run_id={run_id}/attempt={attempt}"


def read_pointer(spark: SparkSession, root: str, table: str):
    """The newest pointer row of a table, or None where no log exists; a log that cannot be read stops the job.

    The pointer log has one row per publish. Should two writers take one sequence, all readers
    follow the same of both.
    """
    try:
        log = spark.read.schema(POINTER_SCHEMA).parquet(f"{root}/_pointer/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.orderBy(F.desc("published_seq"), F.desc("run_id"), F.desc("attempt")).first()


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    pointer = read_pointer(spark, root, table)
    if pointer is None:
        raise LookupError(f"{table} is not published under {root}")
    return spark.read.parquet(run_path(root, table, pointer["run_id"], pointer["attempt"]))


def publish(df: DataFrame, root: str, table: str, run_id: str, checks=None) -> tuple[str, DataFrame]:
    """Replace a table by the rows of ``df`` under ``run_id``.

    Readers follow the pointer, which moves only after the staged rows are written,
    counted and checked. Every attempt writes a folder of its own, so a failed run, also
    of the published run id, leaves the previous table in place. A rerun of the published
    run id is skipped while its rows are all there. ``checks`` maps a staged DataFrame to
    check rows.
    """
    spark = df.sparkSession
    pointer = read_pointer(spark, root, table)
    if pointer is not None and pointer["run_id"] == run_id:
        current = read_published(spark, root, table)
        if current.count() == pointer["row_count"]:
            return "SKIPPED_CURRENT", current
    attempt = uuid.uuid4().hex
    path = run_path(root, table, run_id, attempt)
    df.write.parquet(path)
    staged = spark.read.parquet(path)
    if checks is not None:
        gate(checks(staged))
    sequence = 1 if pointer is None else pointer["published_seq"] + 1
    row = one_row(spark, POINTER_SCHEMA, table, run_id, staged.count(), sequence, attempt)
    row.write.mode("append").parquet(f"{root}/_pointer/{table}")
    return "PUBLISHED", staged


def append(df: DataFrame, path: str) -> None:
    """Append evidence or audit rows."""
    df.write.mode("append").parquet(path)


def publish_views(views: Mapping[str, tuple[DataFrame, Mapping[str, str]]], retired=()) -> list[str]:
    """Register views with column comments; every column must be documented.

    Returns the names, after dropping the retired ones.
    """
    for name, (df, comments) in views.items():
        undocumented = [c for c in df.columns if c not in comments]
        if undocumented:
            raise ValueError(f"view {name} has columns without a comment: {undocumented}")
        described = df.select(
            *[F.col(c).alias(c, metadata={"comment": comments[c]}) for c in df.columns]
        )
        described.createOrReplaceTempView(name)
    for name in retired:
        next(iter(views.values()))[0].sparkSession.catalog.dropTempView(name)
    return sorted(views)


def publish_catalog_views(
    spark: SparkSession, prefix: str, views: Mapping[str, tuple[str, Mapping[str, str]]], retired: Sequence[str] = ()
) -> list[str]:
    """Views of the current database with column comments, as (query text, comment by column).

    The names that begin with ``prefix`` are exactly the given ones afterwards: retired views are
    dropped, and one that is neither given nor retired stops the call before anything changes, as do a
    column without a comment and a comment without a column. Returns the names.
    """
    strange = [name for name in views if not name.startswith(prefix)]
    if strange:
        raise ValueError(f"views outside {prefix}: {strange}")
    here = {row["viewName"] for row in spark.sql(f"SHOW VIEWS LIKE '{prefix}*'").collect() if not row["isTemporary"]}
    left_over = sorted(here - set(views) - set(retired))
    if left_over:
        raise ValueError(f"published views nobody knows: {left_over}")
    columns = {name: spark.sql(text).columns for name, (text, _) in views.items()}
    for name, (_, comments) in views.items():
        if set(columns[name]) != set(comments):
            raise ValueError(f"view {name}: columns {columns[name]}, comments for {sorted(comments)}")
    for name, (text, comments) in views.items():
        told = ", ".join(f"`{c}` COMMENT {_quoted(comments[c])}" for c in columns[name])
        spark.sql(f"CREATE OR REPLACE VIEW {name} ({told}) AS {text}")
    for name in sorted(here & set(retired)):
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    return sorted(views)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
