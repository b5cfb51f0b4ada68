"""Classify the rows of tabular dumps (SRC13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.operators.scale import attach_group_values


def is_blank(cells: Column) -> Column:
    return F.forall(cells, lambda cell: F.trim(cell) == "")


def classify_dump_rows(
    rows: DataFrame, header_row: int, width: int, readable: Column, starts_notes: Column
) -> DataFrame:
    """Give every row of (file, sheet, row_no, cells) exactly one role.

    TITLE down to the header, then BLANK, DATA, NOTE or ISSUE. Only the first ``width``
    cells are the table. Notes begin at the first unreadable row that starts notes; the
    first such row number per sheet is an aggregate, so no ordered scan is needed.
    """
    table = F.slice("cells", 1, width)
    staged = rows.withColumn("table_cells", table)
    title = F.col("row_no") <= header_row
    blank = is_blank(F.col("table_cells"))
    data = F.coalesce(readable, F.lit(False))
    opens = ~title & ~blank & ~data & F.coalesce(starts_notes, F.lit(False))
    marked = attach_group_values(
        staged, ["file", "sheet"], {"__notes_from": F.min(F.when(opens, F.col("row_no")))}
    )
    rest_blank = is_blank(F.slice("table_cells", 2, max(width - 1, 1)))
    in_notes = F.coalesce(F.col("row_no") >= F.col("__notes_from"), F.lit(False))
    role = (
        F.when(title, "TITLE").when(blank, "BLANK").when(data, "DATA").when(in_notes & rest_blank, "NOTE").otherwise("ISSUE")
    )
    return marked.withColumn("row_role", role).drop("__notes_from")


def manifest(classified: DataFrame) -> DataFrame:
    """Row counts per sheet and role; the roles must add up to the rows of the sheet."""
    role = F.col("row_role")
    counts = classified.groupBy("file", "sheet").agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(role == name).alias(f"{name.lower()}_rows") for name in ("TITLE", "BLANK", "DATA", "NOTE", "ISSUE")],
    )
    total = F.col("title_rows") + F.col("blank_rows") + F.col("data_rows") + F.col("note_rows") + F.col("issue_rows")
    return counts.withColumn("adds_up", F.col("total_rows") == total)
