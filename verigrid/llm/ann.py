"""Approximate nearest neighbours: inverted lists with an adaptive scan of rotated dimensions.

Every vector goes to the list of its nearest centroid; long lists are dealt over chunks and the
queries that probe a list over blocks, so a task sees one bounded chunk and one bounded block
whatever a list holds. Inside a chunk the vectors are rotated by a random orthogonal matrix and
stored in blocks of columns. A query scans block after block: a partial distance estimates the
whole one, and a hypothesis test against the best distances so far abandons most candidates early.
What survives is measured on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.llm.common import stage

FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column, size: int | None = None) -> Column:
    """Not null, not zero, every component finite (and ``size`` of them)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good if size is None else good & (F.size(vector) == size), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]


def k_means(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres, 1)[:, 0]
        for c in np.unique(own):
            centres[c] = x[own == c].mean(axis=0)
    return np.unique(centres, axis=0)


def nearest(x: np.ndarray, centres: np.ndarray, n: int, rows: int = 2048) -> np.ndarray:
    """Numbers of the ``n`` nearest centres of each row, nearest first."""
    norms = (centres**2).sum(axis=1)
    out = [np.argsort(norms - 2 * x[a : a + rows] @ centres.T, axis=1, kind="stable")[:, :n] for a in range(0, len(x), rows)]
    return np.concatenate(out) if out else np.empty((0, n), np.int64)


def probes_for(x: np.ndarray, centres: np.ndarray, k: int, recall: float, asked: int = 512) -> int:
    """Lists to probe so that, inside a sample, the true neighbours of ``asked`` rows are reached.

    Neighbours inside a sample lie farther off than in the whole table, so the answer is cautious.
    """
    if len(x) <= k:
        return len(centres)
    rows = np.arange(0, len(x), max(1, len(x) // asked))
    away = (x**2).sum(axis=1) - 2 * x[rows] @ x.T
    away[np.arange(len(rows)), rows] = np.inf
    own = nearest(x, centres, 1)[:, 0][np.argpartition(away, k - 1, axis=1)[:, :k]]
    place = np.argsort(nearest(x[rows], centres, len(centres)), axis=1)
    return int(np.quantile(np.take_along_axis(place, own, axis=1), recall, method="higher")) + 1


class Chunk:
    """Vectors of a list chunk, rotated, in blocks of columns."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, first_block: int = 8):
        self.ids, self.vectors = ids, vectors
        size = vectors.shape[1]
        self.turn = rotation(size)
        turned = vectors @ self.turn
        edges = [0]
        while edges[-1] < size:
            edges.append(min(size, max(first_block, 2 * edges[-1])))
        self.blocks = [(a, b, np.ascontiguousarray(turned[:, a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        self.longest = float((vectors**2).sum(axis=1).max(initial=0.0))

    def search(self, query: np.ndarray, own: int, k: int, strictness: float = 2.1) -> list[tuple[int, float]]:
        """The ``k`` nearest that the tests leave, as (vec_id, distance), nearest first.

        Rotating rounds, so bounds have an absolute slack: exact copies stay however many there are.
        The tests never leave fewer than ``k`` candidates of those that there are.
        """
        turned = query @ self.turn
        size = len(query)
        left = np.flatnonzero(self.ids != own)
        if not left.size:
            return []
        seed = left[: 4 * k]
        whole = ((self.vectors[seed] - query) ** 2).sum(axis=1)
        limit = np.partition(whole, k - 1)[k - 1] if whole.size > k else np.inf
        partial = np.zeros(left.size)
        least = min(k, left.size)
        slack = 1e-12 * (float((query**2).sum()) + self.longest)
        for a, b, block in self.blocks:
            partial = partial + ((block[left] - turned[a:b]) ** 2).sum(axis=1)
            # rotated dimensions are like a random sample, so b of them predict b / size of the distance
            bound = limit * (b / size) * (1 + strictness / np.sqrt(b)) ** 2 if b < size else limit * (1 + 1e-9)
            stay = partial <= bound + slack
            if np.count_nonzero(stay) < least:
                stay[np.argpartition(partial, least - 1)[:least]] = True
            left, partial = left[stay], partial[stay]
            if b < size and left.size > k:
                guess = left[np.argpartition(partial, k - 1)[:k]]
                limit = min(limit, float(((self.vectors[guess] - query) ** 2).sum(axis=1).max()))
        exact = np.sqrt(((self.vectors[left] - query) ** 2).sum(axis=1))
        order = np.lexsort((self.ids[left], exact))[:k]
        return [(int(self.ids[left[i]]), float(exact[i])) for i in order]


def search(
    vectors: DataFrame, queries: Column, k: int = 10, recall: float = 0.96, sample: int = 20_000, chunk: int = 4096,
    block: int = 4096, most_lists: int = 4096,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows that ``queries`` holds for.

    ``vectors`` needs ``vec_id`` and ``embedding``. Vectors that are null, zero, hold a null or
    non-finite component, or differ in length from most vectors, and rows without id take no part.
    A query never finds rows of its own id; repeated candidates are candidates each, a repeated
    query is asked once. Ties go to the smaller id. With fewer than ``k`` candidates all are
    returned, an empty table gives no rows. Centroids come from the ``sample`` vectors with the
    smallest hash of their id; every vector is indexed. The lists
    to probe are as many as reach ``recall`` of the true neighbours inside that sample, and more
    while these hold fewer than ``4 * k`` vectors.
    """
    valid = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    sizes = valid.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = int(sizes["size"])
    valid = valid.filter(F.size("embedding") == size).withColumn("embedding", F.col("embedding").cast("array<double>"))
    lists = int(np.clip(round(np.sqrt(sizes["count"])), 1, most_lists))
    # bounded: `sample` rows
    seen = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    seen = matrix(seen.column("embedding"), size)
    centres = k_means(seen, lists)
    probes = probes_for(seen, centres, k, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = nearest(matrix(batch.column("embedding"), size), centres, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], ["vec_id", "embedding", "list"])

    index = stage(valid.mapInArrow(place, "vec_id bigint, embedding array<double>, list int"), "ann-index")
    # a row per list
    held = {row["list"]: row["count"] for row in index.groupBy("list").count().collect()}
    counts = np.array([held.get(c, 0) for c in range(len(centres))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = nearest(matrix(batch.column("embedding"), size), centres, len(centres))
            reach = np.cumsum(counts[order], axis=1)
            need = np.maximum(probes, (reach < 4 * k + 1).sum(axis=1) + 1)
            need = np.minimum(need, len(centres))
            rows = np.repeat(np.arange(len(order)), need)
            probed = np.concatenate([order[i, :n] for i, n in enumerate(need)]) if len(order) else np.empty(0)
            taken = [batch.column(c).take(pa.array(rows)) for c in ("vec_id", "embedding")]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(probed.astype(np.int32))], ["query_id", "query", "list"])

    asked = index.filter(queries).dropDuplicates(["vec_id"]).select("vec_id", "embedding")
    asked = stage(asked.mapInArrow(probe, "query_id bigint, query array<double>, list int"), "ann-queries")
    shares = index.groupBy("list").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    shares = shares.join(asked.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "list")
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # one row per list; a list in one chunk and one block is sent once
    left = index.join(shares, "list").withColumn("chunk", part("vec_id", "chunks")).withColumn("block", each("blocks"))
    right = asked.join(shares, "list").withColumn("block", part("query_id", "blocks")).withColumn("chunk", each("chunks"))

    def scan(candidates: pa.Table, questions: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if candidates.num_rows and questions.num_rows:
            here = Chunk(candidates.column("vec_id").to_numpy(), matrix(candidates.column("embedding"), size))
            asks = zip(questions.column("query_id").to_pylist(), matrix(questions.column("query"), size), strict=True)
            out = [(q, *found) for q, vector in asks for found in here.search(vector, q, k)]
        columns = zip(*out, strict=True) if out else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

    keys = ["list", "chunk", "block"]
    a = left.select(*keys, "vec_id", "embedding").groupBy(*keys)
    found = a.cogroup(right.select(*keys, "query_id", "query").groupBy(*keys)).applyInArrow(scan, FOUND)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
