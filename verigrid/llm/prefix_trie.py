"""Prefix trie of conversations: subtree totals by time-forward processing.

1. Order. Turns are dealt by ranges of (conversation, turn) and counted in one pass per range; what a
   conversation has in earlier ranges is carried over, so a conversation of any length is spread over
   tasks. Texts are hashed first and never shuffled.
2. Nodes. A prefix is known by its length and two running sums of 64-bit hashes of (turn, place); rows with
   one prefix are one node, counted where they lie before they meet.
3. Time-forward processing. Nodes with one member form the tail of a conversation: a path with one leaf
   that saves nothing, so only the first node of a tail hands its totals up. Other nodes are visited in
   reverse level order; each takes its children's totals out of a priority queue and puts its own in for
   its parent. The queue writes sorted runs to disk when it is full.
4. Shards. Nodes with more than ``limit`` members are the crown: connected, with the root, and at most
   2**18 nodes, since each holds more than ``limit`` of all rows. What hangs below the crown is cut into
   shards of at most ``limit`` conversations, which are processed side by side; the totals of shard roots
   are summed per crown node and the crown is processed last.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verigrid.llm.common import stage, word_count

KEY = ["depth", "a", "b"]
PASSED = (
    "depth bigint, a bigint, b bigint, pa bigint, pb bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "up boolean, n_children bigint, n_leaves bigint, saved_tokens bigint"
)


def running_sums(df: DataFrame, group: str, order: list[str], terms: list[str]) -> DataFrame:
    """``df`` with ``<term>_sum``, running sums of bigint columns inside each group modulo 2**64, and
    ``<term>_before``, the sums without the row itself.

    Rows are dealt by ranges of ``order``, which starts with ``group``; each range is summed in one
    pass. One row per range reaches the driver and tells what the next range has to add.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, sums = df.columns, [f"{t}_{k}" for k in ("sum", "before") for t in terms]
    place = names.index(group)
    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    kind += "".join(f"{s} bigint, " for s in sums)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last, held = TaskContext.get().partitionId(), 0, None, np.zeros(len(terms), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(place).to_numpy()
            new = np.concatenate([[g[0] != last], g[1:] != g[:-1]])
            starts = np.flatnonzero(np.concatenate([[True], new[1:]]))
            x = np.stack([batch.column(names.index(t)).to_numpy() for t in terms])
            total = np.cumsum(x, axis=1)
            total -= np.repeat((total - x)[:, starts], np.diff(np.append(starts, n)), axis=1)
            if not new[0]:
                total[:, : starts[1] if starts.size > 1 else n] += held[:, None]
            last, held = g[-1], total[:, -1].copy()
            at = np.arange(seen, seen + n)
            seen += n
            columns = [*batch.columns, *map(pa.array, total), *map(pa.array, total - x), pa.array(np.full(n, part, np.int32)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *sums, "part", "at"])

    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = stage(dealt.mapInArrow(scan, f"{kind}part int, at bigint"), "sums")
    ends = held.groupBy("part").agg(F.min(group).alias("first"), F.max_by(F.struct(group, *sums[: len(terms)]), "at").alias("last"))
    carry: dict[int, tuple[int, np.ndarray]] = {}
    open_group, so_far = None, np.zeros(len(terms), np.int64)
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # one row per range
        last = np.array(row["last"][1:], np.int64)
        if row["first"] == open_group:
            carry[row["part"]] = (open_group, so_far)
        so_far = so_far + last if row["last"][group] == open_group else last
        open_group = row["last"][group]
    if not carry:
        return held.select(*names, *sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, part = batch.column(place).to_numpy(), batch.column(len(names) + len(sums)).to_numpy()
            x = np.stack([batch.column(len(names) + k).to_numpy() for k in range(len(sums))])
            for p in np.unique(part).tolist():
                if p in carry:
                    x[:, (part == p) & (g == carry[p][0])] += np.tile(carry[p][1], 2)[:, None]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *map(pa.array, x)], [*names, *sums])

    return held.mapInArrow(add, kind.removesuffix(", "))


def ordered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``rank`` (from 1), two hashes and the number of words of each turn.

    Order is by turn, null first; turns of one number are ordered by role and then by the hash of
    their text. Null role and text become empty; rows without ``conv_id`` take no part.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hashes = [F.xxhash64(F.lit(k), role, text).alias(f"t{k}") for k in (1, 2)]
    turn = F.col("turn").alias("turn")
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint"), turn, role.alias("role"), *hashes, word_count(F.col("text")).alias("words"), F.lit(1).cast("bigint").alias("one"))
    counted = running_sums(rows, "conv_id", ["conv_id", "turn", "role", "t1", "t2"], ["one"])
    return counted.select("conv_id", F.col("one_sum").alias("rank"), "t1", "t2", "words")


def grafted(ranked: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one: (rows, conversations).

    Conversation c takes the first h turns of conversation c - c % ``every`` (all if it has fewer,
    none if it is absent) in place of its own first h, where h is crc32 of its decimal id modulo
    ``most``. Rows have ``depth`` (place from 1) and ``ends``; conversations have their ``length``.
    """
    convs = ranked.groupBy("conv_id").agg(F.max("rank").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most)
    convs = stage(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every), "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left")
    convs = convs.withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    heads = ranked.filter(F.col("rank") < most).withColumnRenamed("conv_id", "base")
    lent = convs.filter("m > 0").join(heads, "base").filter("rank <= m").withColumn("depth", F.col("rank"))
    own = ranked.join(convs, "conv_id").filter("rank > h").withColumn("depth", F.expr("rank - h + m"))
    columns = ["conv_id", F.col("depth").cast("bigint"), "t1", "t2", "words", F.expr("depth = length").alias("ends")]
    return lent.select(*columns).unionByName(own.select(*columns)), convs.select("conv_id", F.col("length").cast("bigint"))


class SpillingQueue:
    """A priority queue of equally long tuples of integers; beyond ``most`` it goes to sorted runs on disk.

    A run is a scratch file of the running task without a name; it is gone with the task, and a
    task that is run again makes its own.
    """

    def __init__(self, width: int, most: int = 200_000):
        self.width, self.most = width, most
        self.heap: list[tuple[int, ...]] = []
        self.fronts: list[tuple[tuple[int, ...], int, Iterator]] = []
        self.spilled = 0

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        file.seek(0)
        while data := file.read(8 * self.width * 4096):
            yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, self.width).tolist())
        file.close()

    def push(self, item: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            file = tempfile.TemporaryFile()
            file.write(np.array(sorted(self.heap), np.int64).tobytes())
            run, self.heap = self._read(file), []
            self.spilled += 1
            heapq.heappush(self.fronts, (next(run), self.spilled, run))

    def first(self) -> tuple[int, ...] | None:
        tops = [q[0] for q in (self.heap,) if q] + [q[0][0] for q in (self.fronts,) if q]
        return min(tops, default=None)

    def pop(self) -> tuple[int, ...]:
        item = self.first()
        if self.heap and self.heap[0] == item:
            return heapq.heappop(self.heap)
        _, number, run = self.fronts[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self.fronts)
        else:
            heapq.heapreplace(self.fronts, (following, number, run))
        return item


def time_forward(nodes: DataFrame, most: int) -> DataFrame:
    """Totals of nodes that come shard by shard, deepest first (schema ``PASSED``).

    ``children0``, ``leaves0`` and ``saved0`` are what arrives from outside the shard; a node whose
    ``up`` holds hands nothing on inside its shard.
    """
    names = [field.split()[0] for field in PASSED.split(", ")]
    kinds = [pa.bool_() if n == "up" else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard = SpillingQueue(5, most), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    assert queue.first() is None, "totals for a node that its shard does not hold"
                    shard = row["shard"]
                key = (-row["depth"], row["a"], row["b"])
                children, leaves = row["children0"], row["leaves0"]
                saved = row["saved0"] + (row["n_convs"] - 1) * row["words"]
                while (top := queue.first()) is not None and top[:3] == key:
                    *_, more, gain = queue.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + gain
                leaves = leaves if children else 1
                if not row["up"]:
                    queue.push((1 - row["depth"], row["pa"], row["pb"], leaves, saved))
                out.append((row["depth"], row["a"], row["b"], row["pa"], row["pb"], row["conv_id"], row["parent_conv_id"], row["n_convs"], row["up"], children, leaves, saved))
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    wanted = [n for n in names if n not in ("n_children", "n_leaves", "saved_tokens")]
    ready = nodes.select("shard", *wanted, "words", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("children0", "leaves0", "saved0")])
    return ready.sortWithinPartitions("shard", F.desc("depth"), "a", "b").mapInArrow(run, PASSED)


def handed_up(nodes: DataFrame) -> DataFrame:
    """What nodes hand to their parents, one row per parent; summed where they lie first."""
    totals = [F.count("*").alias("children0"), F.sum("n_leaves").alias("leaves0"), F.sum("saved_tokens").alias("saved0")]
    return nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(*totals)


def end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids that end at each node, joined by commas; ids stream past sorted.

    SHA-256 has to see its bytes one after the other, so the ids of one node pass through one task,
    of which it holds none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, hashlib.sha256()
        for batch in batches:
            out, (depth, a, b, ids) = [], (c.to_numpy() for c in batch.columns)
            if not ids.size:
                continue
            cuts = np.flatnonzero(np.concatenate([[True], (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), ids.size], strict=True):
                here, text = (int(depth[i]), int(a[i]), int(b[i])), ",".join(map(str, ids[i:j].tolist()))
                if here == key:
                    text = f",{text}"
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = here, hashlib.sha256()
                sha.update(text.encode())
            yield told(out)
        if key is not None:
            yield told([(*key, sha.hexdigest())])

    def told(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[], [], [], []]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [*KEY, "ends_sha256"])

    dealt = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return dealt.mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame, least: int = 1000, most: int = 200_000) -> DataFrame:
    """Nodes of the trie over ``rows`` (conv_id, depth from 1, t1, t2, words, ends) and ``convs``
    (conv_id, length): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. No conversation gives no node, not even a root.
    """
    term = lambda k: F.xxhash64(F.lit(k), "t1", "t2", "depth").alias("xy"[k])
    rows = rows.select("conv_id", "depth", "words", "ends", term(0), term(1))
    sums = running_sums(rows, "conv_id", ["conv_id", "depth"], ["x", "y"])
    names = {"x_sum": "a", "y_sum": "b", "x_before": "pa", "y_before": "pb"}
    rows = sums.select("conv_id", "depth", "words", "ends", *[F.col(k).alias(v) for k, v in names.items()])
    rows = stage(rows, "prefixes")
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if(F.col("length") == 0).alias("n_ends")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), *[zero.alias(c) for c in ("a", "b")], *[F.lit(None).cast("bigint").alias(c) for c in ("pa", "pb")], "n_convs", "conv_id", zero.alias("words"), "n_ends")
    nodes = rows.groupBy(*KEY, "pa", "pb").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("words").alias("words"), F.count_if("ends").alias("n_ends"))
    nodes = stage(nodes.unionByName(root), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"))
    nodes = stage(nodes.join(above, ["depth", "pa", "pb"], "left"), "nodes-with-parents")
    limit = max(least, rows.count() >> 18)
    crowned = F.expr(f"n_convs > {limit} OR depth = 0")
    tails = nodes.filter("n_convs = 1").withColumns({"n_children": 1 - F.col("n_ends"), "n_leaves": F.lit(1).cast("bigint"), "saved_tokens": zero})
    shared = nodes.filter("n_convs > 1").withColumn("up", F.expr(f"parent_n > {limit} OR depth <= 1"))
    crown = shared.filter(crowned)  # at most 2**18 nodes beside the root
    kept = rows.join(F.broadcast(crown.select(*KEY)), KEY, "left_anti")
    shards = kept.groupBy("conv_id").agg(F.xxhash64(F.min_by(F.struct(*KEY), "depth")).alias("shard"))
    from_tails = stage(handed_up(tails.filter("parent_n > 1")), "tails")
    low = shared.filter(~crowned).join(shards, "conv_id").join(from_tails, KEY, "left")
    low = stage(time_forward(low.repartition("shard"), most), "shards")
    arrived = from_tails.unionByName(handed_up(low.filter("up")))
    arrived = arrived.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("children0", "leaves0", "saved0")])
    top = crown.withColumns({"shard": zero, "up": F.expr("depth = 0")}).join(arrived, KEY, "left")
    top = time_forward(top.repartition(1), most)
    columns = [*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ready = tails.select(*columns).unionByName(low.select(*columns)).unionByName(top.select(*columns))
    ends = rows.filter("ends").select(*KEY, "conv_id").unionByName(convs.filter("length = 0").select(*[zero.alias(c) for c in KEY], "conv_id"))
    ready = ready.join(end_hashes(ends), KEY, "left")
    return ready.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, least: int = 1000, most: int = 200_000) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Null turns come first, null role and text are empty, repeated rows are turns each, rows without
    ``conv_id`` take no part, other columns are ignored, an empty table gives no rows. Prefixes are
    told apart by 128 bits of hashes. ``least`` is the smallest limit of a shard's conversations,
    ``most`` the messages a queue holds in memory; neither changes the result.
    """
    ranked = ordered(turns.select("conv_id", "turn", "role", "text"))
    return trie(*grafted(ranked), least, most)
