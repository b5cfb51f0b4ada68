"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("verigrid")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="verigrid-")
    return _local_folders[context.applicationId]
