"""Stage tables: cut a long lineage with a written table in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from verigrid.session import work_dir


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a stage once and read it back.

    Stages that several later branches read would otherwise be recomputed by each of
    them, and the plan would grow with every branch. The table is columnar, so the
    branches still prune columns, and it outlives any executor. Only the folder name
    is random; no row depends on it.
    """
    path = f"{work_dir(df.sparkSession)}/stage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
