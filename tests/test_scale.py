"""The scans must equal plain windows, also when one key holds most rows."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.operators import scale


def skewed(spark, rows=3000, seed=7):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        key = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        mark = rng.choice([None, None, None, "x", "reset"])
        data.append((key, i, rng.choice([None, *range(12)]), mark))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, n long, v long, mark string")


def same(a, b):
    rows = lambda d: sorted((tuple(r) for r in d.select(*a.columns).collect()), key=repr)
    return rows(a) == rows(b)


def test_running_values(spark):
    df = skewed(spark)
    window = W.partitionBy("k").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum("v").over(window))
    for width in (1, 64, 10**6, None):
        block = F.floor(F.col("n") / width) if width else None
        got = scale.running_values(df, ["k"], [F.col("n")], block, {"s": F.col("v")})
        assert same(want, got)


def test_measured_blocks_cut_a_key_with_all_rows(spark):
    joining = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(joining)
    spark.conf.set(joining, "false")
    try:
        rows = spark.range(20_000).select(
            F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), (-F.col("id")).alias("n"), (F.col("id") % 7).alias("v")
        )
        blocks = scale.measured_blocks(rows, ["k"], [F.col("n")]).groupBy("__block").count()
        hot = [r["count"] for r in blocks.filter("__block.k is null").collect()]
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # 18,000 rows of the NULL key lie in nearly all ranges, none of which holds much more than its share
        assert len(hot) >= 3 * ranges // 4 and sum(hot) == 18_000 and max(hot) < 1.5 * 20_000 / ranges
        # summaries: other keys have one row and one block each
        assert blocks.count() == len(hot) + 2_000
        window = W.partitionBy("k").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
        want = rows.withColumn("s", F.sum("v").over(window))
        assert same(want, scale.running_values(rows, ["k"], [F.col("n")], None, {"s": F.col("v")}))
        falling = W.partitionBy("k").orderBy(F.col("n").desc()).rowsBetween(W.unboundedPreceding, -1)
        want = rows.withColumn("s", F.sum("v").over(falling))
        assert same(want, scale.running_values(rows, ["k"], [F.col("n").desc()], None, {"s": F.col("v")}, strict=True))
        none = scale.running_values(rows.limit(0), ["k"], [F.col("n")], None, {"s": F.col("v")})
        assert none.count() == 0
    finally:
        spark.conf.set(joining, before)


def test_carry_forward_with_reset(spark):
    df = skewed(spark)
    mark = F.when(F.col("mark") == "reset", F.struct(F.lit(None).cast("string").alias("c"))).when(
        F.col("mark") == "x", F.struct(F.col("n").cast("string").alias("c"))
    )
    for strict, upper in ((False, 0), (True, -1)):
        window = W.partitionBy("k").orderBy("n").rowsBetween(W.unboundedPreceding, upper)
        want = df.withColumn("c", F.last(mark, ignorenulls=True).over(window))
        for block in (3, 100, 10**6, None):
            got = scale.carry_forward(df, ["k"], "n", block, {"c": mark}, strict=strict)
            assert same(want, got)


def test_rank_by_value(spark):
    df = skewed(spark)
    window = W.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    want = df.withColumn("r", F.rank().over(window).cast("bigint"))
    block = F.coalesce(-F.floor(F.col("v") / 3), F.lit(99))
    assert same(want, scale.rank_by_value(df, ["k"], "v", "r", block))


def test_latest_per_key_and_batch(spark):
    df = skewed(spark)
    window = W.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("n").desc())
    want = df.withColumn("__r", F.row_number().over(window)).filter("__r = 1").drop("__r")
    assert same(want, scale.latest_per_key(df, ["k"], [F.col("v"), F.col("n")]))
    newest = df.withColumn("__m", F.max("v").over(W.partitionBy("k"))).filter("v = __m").drop("__m")
    assert same(newest, scale.latest_batch(df, ["k"], "v"))


def test_identical_row_ordinals_over_chunks(spark):
    df = skewed(spark).select("k", "v")
    window = W.partitionBy("k", "v").orderBy("k")
    want = df.withColumn("o", F.row_number().over(window).cast("bigint"))
    for chunk in (1, 50, 10**6):
        assert same(want, scale.identical_row_ordinals(df, "o", chunk))


def test_lookup_keeps_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, x int")
    right = spark.createDataFrame([("a", "A"), (None, "N")], "k string, y string")
    assert {tuple(r) for r in scale.lookup(left, right, ["k"]).collect()} == {("a", 1, "A"), (None, 2, "N"), ("z", 3, None)}


def test_context_of_two_rows_stops(spark):
    import pytest

    with pytest.raises(Exception):
        scale.with_context(spark.range(3), spark.range(2).withColumnRenamed("id", "c")).collect()
