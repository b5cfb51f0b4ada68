"""Mixing sources to target weights by systematic sampling.

Targets share out a multiple of all words by weight; a source stops at ``most`` times its size and
what it cannot take is shared out again. Every document of a source is expected ``rate`` times.
The documents of a source stand in order of size; the prefix sum of their expected copies plus one
random offset is cut at the integers, and a document is taken once per integer it crosses. Since
neighbours are of like size, the words taken stay within about one large document of the target.
The offset is the best of ``trials`` pseudo-random ones per source, which brings it nearer still.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.llm.common import stage, word_count


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Target words per source from rows (``source``, ``source_size``), one row per source.

    The order of sources is by code point with null last; weights repeat along it. With capacities
    ``most * size`` the shares end at one level per unit of weight: sources whose capacity per
    weight lies below the level are full. The windows see one row per source only.
    """
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    by_ratio = W.orderBy("ratio", "number")
    ranked = (
        sizes.withColumns({"number": number, "weight": weight, "cap": F.col("source_size") * most})
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("full", F.sum("cap").over(by_ratio) - F.col("cap"))
        .withColumn("left", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn("level", (F.lit(float(share)) * F.col("all") - F.col("full")) / F.col("left"))
    )
    open_level = F.when(F.col("ratio") >= F.col("level"), F.col("level"))
    level = F.min_by(open_level, F.when(open_level.isNotNull(), F.struct("ratio", "number"))).over(everything)
    return ranked.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target")
    )


def offset(source: Column, trial: Column | int, seed: str) -> Column:
    """A number in [0, 1) from source, trial and seed; the same on every run."""
    label = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
    trial = F.lit(trial) if isinstance(trial, int) else trial
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), trial.cast("string"), label)), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def numbered(df: DataFrame, key: str, order: Sequence[Column], label: str) -> DataFrame:
    """Add ``index``, the place of each row within its key, from 0.

    Rows are sorted over partitions by (key, order) and written once; the place is the row's place
    in its partition plus what earlier partitions hold of its key. A key may fill any number of
    partitions; the summary has a row per partition and key.
    """
    keys = [F.col(key).asc_nulls_last(), *order]
    serial = F.monotonically_increasing_id()
    placed = stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("serial", serial), label)
    part = F.shiftright("serial", 33)
    blocks = placed.groupBy(part.alias("part"), key).agg(F.min("serial").alias("first"), F.count("*").alias("held"))
    before = F.sum("held").over(W.partitionBy(key).orderBy("part")) - F.col("held")
    blocks = blocks.select(
        F.col("part").alias("b_part"), F.col(key).alias("b_key"), "first", before.alias("before")
    )
    met = (part == F.col("b_part")) & F.col(key).eqNullSafe(F.col("b_key"))
    index = (F.col("serial") - F.col("first") + F.col("before")).alias("index")
    return placed.join(blocks, met).select(*[F.col(f"`{c}`") for c in df.columns], index)


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, trials: int = 16,
    seed: str = "mix",
) -> DataFrame:
    """The columns of ``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``, or ``size`` in place of ``text``. Every row
    comes back once; ``copies`` (0 to ``most``) says how often the mix takes it and ``taken`` is
    ``copies * size``. Null texts have size 0, null sources are one source of their own, equal rows
    are separate documents, a source without words has target 0 and an empty table gives no rows.
    Columns of the given names are replaced.
    """
    added = ("source_size", "target", "copies", "taken", "index")
    docs = docs.drop(*added)
    sized = docs if "size" in docs.columns and "text" not in docs.columns else docs.withColumn("size", word_count(F.col("text")))
    rows = numbered(sized, "source", [F.col("size").desc(), F.col("doc_id")], "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stage(targets(sizes, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    aims = aims.withColumn("rate", rate).withColumnRenamed("source", "aim")
    met = F.col("source").eqNullSafe(F.col("aim"))

    def copies(start: Column) -> Column:
        upper, lower = F.col("index") + 1, F.col("index")
        return F.floor(upper * F.col("rate") + start) - F.floor(lower * F.col("rate") + start)

    # one pass over the sizes tells what each trial would take of each source
    tried = rows.select("source", "size", "index").join(aims, met)
    sums = [F.sum(copies(offset(F.col("aim"), t, seed)) * F.col("size")).alias(f"t{t}") for t in range(trials)]
    found = tried.groupBy("aim", "target").agg(*sums)
    choices = F.array(*[
        F.struct(F.abs(F.col(f"t{t}") - F.col("target")).alias("off"), F.lit(t).alias("trial")) for t in range(trials)
    ])
    best = found.select(F.col("aim").alias("chosen_for"), F.array_min(choices)["trial"].alias("trial"))
    chosen = aims.join(best, F.col("aim").eqNullSafe(F.col("chosen_for")))
    chosen = chosen.withColumn("offset", offset(F.col("aim"), F.col("trial"), seed))
    chosen = chosen.select("aim", "source_size", "target", "rate", "offset")
    out = rows.join(chosen, met).withColumn("copies", copies(F.col("offset")))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[F.col(f"`{c}`") for c in sized.columns], "source_size", "target", "copies", "taken")


def repeat(mixed: DataFrame) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
