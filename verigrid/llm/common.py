"""Helpers that several operators share: text batches, word bytes, stage tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verigrid.session import work_dir
from verigrid.sinks.stage import materialize

#: Fixed value: a word is a run of characters outside this class.
WORD = r"[^\x20\x09-\x0D]+"
#: The same blanks as bytes; ``bytes.split()`` uses exactly these.
BLANKS = b" \t\n\x0b\x0c\r"

_passing: ContextVar[str] = ContextVar("passing", default="")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a stage once and read it back; inside ``passing_stages`` it goes with the block."""
    return materialize(df, _passing.get() + label)


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """Stages written inside the block are removed at its end.

    What outlives the block has to be written with ``materialize`` inside it.
    """
    folder = f"passing-{uuid.uuid4().hex}"
    before = _passing.set(f"{folder}/")
    try:
        yield
    finally:
        _passing.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/stage/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text is an empty one."""
    return [text or "" for text in batch.column(name).to_pylist()]


#: What operators keep in a worker between its tasks, such as encoders with their tables of words.
WORKER_TABLES: dict[tuple, object] = {}


def begin_without_tables() -> None:
    """A reused worker drops what another operator has left in it; results never depend on it."""
    if WORKER_TABLES:
        WORKER_TABLES.clear()
        give_back()


def parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in short parts, so that few texts are Python objects at a time."""
    for batch in batches:
        yield from (batch.slice(first, rows) for first in range(0, batch.num_rows, rows))


def give_back() -> None:
    """Memory of batches and arrays that are gone goes back to the system, not only to the allocators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other systems' allocators do without
    if trim is not None:
        trim(0)


def slices(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of about ``size`` characters, so memory follows the run."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z only; ``bytes.lower`` leaves every other byte alone."""
    return text.lower()


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, whatever else the table holds."""
    return df.select(*[F.col(f"`{name}`") for name in names])
