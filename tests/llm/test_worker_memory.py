"""What a Python worker holds while it runs a step of the pipeline, and after it."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from verigrid.llm import common, jaccard, quality, tokens

ROWS = 3000


class Table:
    """Stands for a DataFrame; hands out what would run in the worker."""

    columns = ["doc_id", "text"]
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])

    def select(self, *_):
        return self

    drop = select

    def mapInArrow(self, run, _):
        return run


def one_batch():
    """One batch of 3,000 texts, 9 MB; every third text repeats the first of them."""
    rng = np.random.default_rng(7)
    words = np.array([f"word{i}" for i in range(2000)])
    texts = [" ".join(words[rng.integers(0, 2000, 400)]) for _ in range(ROWS)]
    texts[::3] = [texts[0]] * len(texts[::3])
    return pa.RecordBatch.from_arrays([pa.array(range(ROWS), pa.int64()), pa.array(texts)], ["doc_id", "text"])


STEPS = {
    "quality": (lambda: quality.judge(Table(), None), 4),
    "sets": (lambda: jaccard.sets_and_counts(Table(), 5, 3_000_000), 32),
    "prefixes": (lambda: jaccard.prefixes(Table(), 5, 75, np.empty(0, np.uint64)), 8),
}


@pytest.mark.parametrize("name", STEPS)
def test_a_worker_holds_few_texts_at_a_time(name):
    make, most_mb = STEPS[name]
    batch = one_batch()
    if name == "prefixes":
        batch = batch.select(["text"])
    run = make()
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    # equal sets still post once per batch: 2,001 different sets of 396 shingles, 100 of them in a prefix
    assert rows >= ROWS if name != "prefixes" else rows == 2001 * 100
    assert peak < most_mb, f"{peak:.1f} MB"


def test_repeated_values_are_counted():
    rng = np.random.default_rng(1)
    for sizes in ([0], [1], [5, 0, 7], [300, 200, 100]):
        held = [rng.integers(0, 50, n).astype(np.uint64) for n in sizes]
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        found, times = jaccard.repeated(held)
        assert found.tolist() == values[counts > 1].tolist() and times.tolist() == counts[counts > 1].tolist()
        assert not held


def test_a_reused_worker_drops_the_tables_of_another_operator():
    tokens.encoder(public_tokenizers.path("word_bpe_49k.json"), False).encode(["some words of a text"])
    assert common.WORKER_TABLES
    list(quality.judge(Table(), None)(iter([one_batch().slice(0, 10)])))
    assert not common.WORKER_TABLES
