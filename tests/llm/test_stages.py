"""Stage tables of a pipeline stage go when the stage has its result."""

from pathlib import Path

import corpus_pipeline
from verigrid.session import work_dir


def test_near_duplicates_leave_only_the_components(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "a"), (2, words + " end", "b"), (3, words, None), (4, None, "a"), (5, "other words of some length here", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    folder = Path(work_dir(spark).removeprefix("file:")) / "stage"
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    left = {p.name for p in folder.iterdir()} - before
    assert [name.split("-")[0] for name in left] == ["components"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]
