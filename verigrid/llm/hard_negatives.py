"""Hard negatives by exact integer scores, counted with the method of the Four Russians.

Vectors become integers. A candidate keeps them as packed bit planes: for each plane (two's complement)
and each eight dimensions one byte. An anchor precomputes, for each eight dimensions, the sums of all 256
subsets of its numbers. A score is then one lookup per byte, summed over the groups of a plane, and the
planes are joined by shifts and adds; nothing is multiplied and nothing is rounded.

Anchors and candidates meet in bounded blocks: first the candidates of an anchor's own label, for its
positives, then all candidates, for negatives whose score lies in the window of a positive. Each block
gives its own best few, and the best of those are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.llm.common import stage

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def pack_planes(codes: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of integers (rows, dimensions) as bytes (rows, bits, groups of eight dimensions)."""
    n, size = codes.shape
    padded = np.zeros((n, -(-size // 8) * 8), np.int64)
    padded[:, :size] = codes
    planes = (padded[:, None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The integers of bit planes; the highest plane counts negative."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(planes.shape[1])
    weights[-1] *= -1
    return (bits * weights[:, None]).sum(axis=1)


def subset_sums(codes: np.ndarray, kind: type) -> np.ndarray:
    """Tables (groups, 256, anchors): sums of each subset of an anchor's eight numbers, by doubling."""
    anchors, size = codes.shape
    tables = np.zeros((size // 8, 256, anchors), kind)
    for k in range(8):
        tables[:, 1 << k : 2 << k] = tables[:, : 1 << k] + codes[:, k::8].T[:, None, :].astype(kind)
    return tables


def scores(planes: np.ndarray, tables: np.ndarray, rows: int = 256) -> np.ndarray:
    """Inner products (rows, anchors): lookups summed over groups, planes joined from the top by shifts."""
    n, bits, groups = planes.shape
    out = np.empty((n, tables.shape[2]), tables.dtype)
    for first in range(0, n, rows):
        part = planes[first : first + rows]
        total = np.zeros((len(part), tables.shape[2]), tables.dtype)
        for plane in reversed(range(bits)):
            total <<= 1
            for group in range(groups):
                found = tables[group].take(part[:, plane, group], axis=0)
                total = total - found if plane == bits - 1 else np.add(total, found, out=total)
        out[first : first + rows] = total
    return out


class Batch:
    """Rows of a block as arrays, in the order of their ids."""

    def __init__(self, table: pa.Table, bits: int, groups: int):
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        self.ids = table.column("vec_id").to_numpy()[order]
        self.labels = table.column("label").to_numpy()[order]
        self.rows = table.column("row").to_numpy()[order]
        flat = b"".join(table.column("planes").take(pa.array(order)).to_pylist())
        self.planes = np.frombuffer(flat, np.uint8).reshape(-1, bits, groups)
        self.order = order


def packed(vectors: DataFrame, label: Column, scale: int) -> tuple[DataFrame, int, int]:
    """(row, vec_id, label, planes) of the rows that take part, bits and groups of eight dimensions."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(label.isNotNull() & ~bad)
    rows = rows.select(F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    top = F.max(F.coalesce(F.array_max(F.transform("x", F.abs)), F.lit(0.0))).alias("top")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), top).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None or not sizes["size"]:
        return rows.select(F.lit(0).cast("bigint").alias("row"), "vec_id", "label", F.lit(b"").alias("planes")).limit(0), 1, 1
    size = int(sizes["size"])
    bits = int(np.floor(sizes["top"] * scale) + 1).bit_length() + 1
    if 2 * bits + size.bit_length() > 64:
        raise ValueError("scores of these vectors do not fit a bigint")
    groups = -(-size // 8)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            planes = pack_planes(np.floor(x * scale).astype(np.int64), bits)
            flat = pa.py_buffer(planes.tobytes())
            column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bits * groups), len(x), [None, flat])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], column.cast(pa.binary())], ["vec_id", "label", "planes"])

    made = rows.filter(F.size("x") == size).mapInArrow(pack, "vec_id bigint, label bigint, planes binary")
    return stage(made.select(F.monotonically_increasing_id().alias("row"), "*"), "planes"), bits, groups


def met(candidates: DataFrame, anchors: DataFrame, key: Column, rows: int, block: int):
    """Candidates and anchors cogrouped by blocks of at most about ``rows`` and ``block`` rows of a key."""
    candidates, anchors = (df.withColumn("key", key) for df in (candidates, anchors))
    share = lambda df, n, name: df.groupBy("key").agg(F.ceil(F.count("*") / n).cast("int").alias(name))
    shares = share(candidates, rows, "chunks").join(share(anchors, block, "blocks"), "key")
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = candidates.join(shares, "key").withColumn("chunk", part("chunks")).withColumn("block", each("blocks"))
    right = anchors.join(shares, "key").withColumn("block", part("blocks")).withColumn("chunk", each("chunks"))
    keys = ["key", "chunk", "block"]
    return left.drop("chunks", "blocks").groupBy(*keys).cogroup(right.drop("chunks", "blocks").groupBy(*keys))


def arrays(schema: list[tuple[str, type]], parts: list[tuple]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, k) for _, k in schema]
    return pa.table([pa.array(c.astype(k)) for c, (_, k) in zip(columns, schema, strict=True)], [n for n, _ in schema])


def mine(
    vectors: DataFrame, anchor: Column, label: Column | None = None, scale: int = 256, positives: int = 5,
    negatives: int = 3, low: int = 50, high: int = 95, rows: int = 2048, block: int = 512,
) -> DataFrame:
    """Hard negatives of the rows that ``anchor``, an expression over ``vec_id``, holds for (schema ``RESULT``).

    ``vectors`` needs ``vec_id``, ``embedding`` and, unless ``label`` is given, ``label``. Rows with a
    null id, label or vector, with a null or non-finite component, or of another length than most
    take no part; zero vectors do. Scores are integer inner products of floor(``scale`` * x). An
    anchor's positives are its first ``positives`` rows of other ids and the same label, and of the
    rows of other labels with ``low`` * p <= 100 * n <= ``high`` * p the first ``negatives`` are
    returned for each positive score p; higher scores come first, ties by smaller id. Repeated rows
    are candidates each, equal repeated anchors ask once. An anchor without positives or negatives,
    and an empty table, give no rows; other columns are ignored.
    """
    candidates, bits, groups = packed(vectors, F.col("label") if label is None else label, scale)
    wide = 2 * bits + (8 * groups).bit_length()
    kind = np.int32 if wide < 31 else np.int64
    anchors = stage(candidates.filter(anchor).dropDuplicates(["vec_id", "label", "planes"]), "anchors")
    pair = [("row", np.int64), ("vec_id", np.int64), ("score", np.int64)]

    def best(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and asked.num_rows:
            here, there = Batch(found, bits, groups), Batch(asked, bits, groups)
            s = scores(here.planes, subset_sums(unpack_planes(there.planes), kind)).astype(np.int64)
            for k in range(len(there.ids)):
                own = np.flatnonzero(here.ids != there.ids[k])
                first = own[np.argsort(-s[own, k], kind="stable")[:positives]]
                out.append((np.full(first.size, there.rows[k]), here.ids[first], s[first, k]))
        return arrays(pair, out)

    order = [F.desc("score"), "vec_id"]
    near = met(candidates, anchors, F.col("label"), rows, block).applyInArrow(best, "row bigint, vec_id bigint, score bigint")
    number = F.row_number().over(W.partitionBy("row").orderBy(*order))
    near = near.withColumn("number", number).filter(F.col("number") <= positives)
    # at most `positives` entries
    near = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("number", F.col("vec_id").alias("id"), "score"))).alias("near"))
    asked = stage(anchors.join(near, "row").select("row", "vec_id", "label", "planes", F.expr("transform(near, x -> x.score)").alias("scores"), F.expr("transform(near, x -> x.id)").alias("ids")), "positives")
    result = [("row", np.int64), ("number", np.int64), ("vec_id", np.int64), ("score", np.int64)]

    def within(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if found.num_rows and asked.num_rows:
            here, there = Batch(found, bits, groups), Batch(asked, bits, groups)
            wanted = asked.column("scores").take(pa.array(there.order)).to_pylist()
            s = scores(here.planes, subset_sums(unpack_planes(there.planes), kind)).astype(np.int64)
            for k, positive in enumerate(wanted):
                lows, highs = [-(-low * p // 100) for p in positive], [high * p // 100 for p in positive]
                column = s[:, k]
                fits = np.flatnonzero((column >= min(lows)) & (column <= max(highs)) & (here.labels != there.labels[k]))
                fits = fits[np.argsort(-column[fits], kind="stable")]
                down = -column[fits]
                for number, (a, b) in enumerate(zip(lows, highs, strict=True)):
                    first, last = np.searchsorted(down, -b), np.searchsorted(down, -a, side="right")
                    mine = fits[first : min(last, first + negatives)]
                    out.append((np.full(mine.size, there.rows[k]), np.full(mine.size, number), here.ids[mine], column[mine]))
        return arrays(result, out)

    hard = met(candidates, asked, F.lit(0), rows, block)
    hard = hard.applyInArrow(within, "row bigint, number bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("row", "number").orderBy(*order))
    hard = hard.withColumn("rank", rank).filter(F.col("rank") <= negatives).withColumnRenamed("vec_id", "negative_id")
    out = hard.join(asked.select("row", F.col("vec_id").alias("anchor_id"), "ids", "scores"), "row")
    at = lambda c: F.col(c)[F.col("number").cast("int")]
    return out.select("anchor_id", at("ids").alias("positive_id"), "rank", "negative_id", at("scores").alias("positive_score"), F.col("score").alias("negative_score"))
