"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

* Equal vectors are one class with a weight; only classes are compared.
* A class goes to the cell of its nearest centre. Of two linked vectors in different cells, the one in
  the later cell visits the earlier one, so every pair meets once. A vector visits a cell if it lies
  within a margin of the plane between the two centres: on such a plane, linked vectors differ by their
  difference along one direction only, of which the margin is ``slack`` standard deviations, or more
  where the sample shows more.
* Rows within half the linking angle of their centre are the cell's core: all of them are linked, so
  nothing is multiplied among them, whatever their number, and only rows near enough to the centre meet
  the core. Everything else is compared in products of two bounded blocks.
* A product gives, for each of its rows, the number of links and the smallest row that it reaches
  inside the product, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.llm.ann import matrix, usable
from verigrid.llm.common import stage
from verigrid.llm.graph import components

FRINGE, VISITOR, CORE = 0, 1, 2
FOUND = "class bigint, vec_id bigint, links bigint, label bigint"


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def spherical_k_means(x: np.ndarray, cells: int, least: float, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centres of unit vectors; a centre that is linked to a fuller one is given up."""
    centres = x[np.random.default_rng(seed).choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        for c in np.unique(own):
            mean = x[own == c].sum(axis=0)
            if (length := np.sqrt(mean @ mean)) > 1e-9:
                centres[c] = mean / length
    full = np.bincount(nearest(x, centres), minlength=len(centres))
    kept: list[int] = []
    for c in np.argsort(-full, kind="stable").tolist():
        if full[c] and not (kept and (centres[kept] @ centres[c]).max() >= least):
            kept.append(c)
    return centres[kept]


def nearest(x: np.ndarray, centres: np.ndarray, rows: int = 4096) -> np.ndarray:
    return np.concatenate([(x[a : a + rows] @ centres.T).argmax(axis=1) for a in range(0, len(x), rows)])


def margin(x: np.ndarray, centres: np.ndarray, least: float, slack: float, asked: int = 512) -> float:
    """How far from the plane between two centres a linked vector can lie, at distance 1 of the pair's ends."""
    most, own = slack / np.sqrt(x.shape[1]), nearest(x, centres)
    for i in range(0, len(x), max(1, len(x) // asked)):
        near = np.flatnonzero((x @ x[i] >= least) & (own != own[i]))
        away, apart = x[near] - x[i], centres[own[near]] - centres[own[i]]
        long = np.sqrt((away**2).sum(axis=1) * (apart**2).sum(axis=1))
        most = max(most, 1.2 * float((np.abs((away * apart).sum(axis=1)) / np.maximum(long, 1e-12)).max(initial=0)))
    return min(1.0, most) * np.sqrt(2 - 2 * least)


def local_labels(linked: np.ndarray, ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and each column of a block reaches by its links."""
    n = len(ids)
    both, number = np.unique(np.concatenate([ids, others]), return_inverse=True)
    parent = np.arange(both.size)
    row, column = np.nonzero(linked)
    row, column = number[:n][row], number[n:][column]
    while True:
        a, b = parent[row], parent[column]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return both[parent[number[:n]]], both[parent[number[n:]]]
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]


def product(table: pa.Table, size: int, least: float) -> pa.Table:
    """Links and labels of the rows of two blocks; a block that meets itself has one side."""
    sides = [table.filter(pc.equal(table.column("side"), side)) for side in (0, 1)]
    alone = sides[1].num_rows == 0
    one, two = sides[0], sides[0] if alone else sides[1]
    linked = unit(matrix(one.column("x"), size)) @ unit(matrix(two.column("x"), size)).T >= least if one.num_rows else np.zeros((0, 0), bool)
    if alone:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return pa.table([pa.array([], pa.int64())] * 4, ["class", "vec_id", "links", "label"])
    mine, theirs = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    linked = linked[np.ix_(mine, theirs)]
    one, two = one.take(pa.array(mine)), two.take(pa.array(theirs))
    value = lambda t, name: t.column(name).to_numpy()
    a, b = local_labels(linked, value(one, "vec_id"), value(two, "vec_id"))
    parts = [(one, linked @ value(two, "weight"), a)]
    if not alone:
        parts.append((two, value(one, "weight") @ linked, b))
    columns = [np.concatenate(c) for c in zip(*[(value(t, "class"), value(t, "vec_id"), n, label) for t, n, label in parts], strict=True)]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], ["class", "vec_id", "links", "label"])


def blocks(placed: DataFrame, chunk: int) -> DataFrame:
    """Placed rows once for each product that they take part in: (cell, kind, i, j, side)."""
    core, fringe, visitor = (F.col("role") == r for r in (CORE, FRINGE, VISITOR))
    near = F.col("near") & ~core
    count = lambda c, name: F.ceil(F.count_if(c) / chunk).cast("int").alias(name)
    shares = placed.groupBy("cell").agg(count(fringe, "f"), count(visitor, "v"), count(near, "n"), count(core, "c"))
    rows = placed.join(shares, "cell")
    own = lambda n: F.pmod(F.xxhash64("class"), F.greatest(F.col(n), F.lit(1))).cast("int")
    each = lambda n: F.explode(F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)))
    kept = ["class", "vec_id", "weight", "x"]

    def dealt(condition: Column, kind: int, mine: str, theirs: str, side: int) -> DataFrame:
        out = rows.filter(condition).withColumns({"p": own(mine), "q": each(theirs)})
        i, j = ("p", "q") if side == 0 else ("q", "p")
        return out.select("cell", F.lit(kind).alias("kind"), F.col(i).alias("i"), F.col(j).alias("j"), F.lit(side).alias("side"), *kept)

    inside = rows.filter(fringe).withColumns({"p": own("f"), "q": each("f")})
    inside = inside.select("cell", F.lit(0).alias("kind"), F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), F.expr("IF(p <= q, 0, 1)").alias("side"), *kept)
    return (
        inside.unionByName(dealt(visitor, 1, "v", "f", 0)).unionByName(dealt(fringe, 1, "f", "v", 1))
        .unionByName(dealt(near, 2, "n", "c", 0)).unionByName(dealt(core, 2, "c", "n", 1))
    )


def groups(
    vectors: DataFrame, least: float = 0.9, slack: float = 3.5, sample: int = 20_000, most_cells: int = 4096,
    chunk: int = 2048,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors`` (vec_id, embedding).

    Rows are linked at a cosine of ``least`` (above 0) or more. Vectors that are null, zero, hold null or
    non-finite components, or have another length than most, and rows without id, link with nothing
    and are kept. Repeated rows are vectors each, linked with each other; rows of one id are in one
    component. Centres and margin come from the ``sample`` classes with the smallest hashes; every
    row is placed and compared. Every link between vectors whose difference is spread over the
    dimensions is found but for a few in ten thousand right at ``least``; no link is made up. Other
    columns are ignored, an empty table gives no rows.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("x"))
    usual = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("x"))).groupBy(F.size("x").alias("size")).count()
    usual = usual.orderBy(F.desc("count"), F.desc("size")).first()
    size = int(usual["size"]) if usual else 1
    valid = F.col("vec_id").isNotNull() & usable(F.col("x"), size)
    key = [F.when(valid, F.xxhash64(F.lit(k), "x")).alias(f"h{k}") for k in (1, 2)]
    hashed = rows.select("vec_id", "x", *key)
    classes = hashed.filter("h1 IS NOT NULL").groupBy("h1", "h2")
    classes = classes.agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("x").alias("x"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("class"), "*"), "classes")
    n = classes.count()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    seen = classes.orderBy(F.xxhash64("h1"), "h1", "h2").limit(sample).select("x").toArrow()  # bounded: `sample` rows
    seen = unit(matrix(seen.column("x"), size))
    centres = spherical_k_means(seen, int(np.clip(round(np.sqrt(n) / 2), 1, most_cells)), least)
    reach = margin(seen, centres, least, slack)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    angle = np.arccos(least)
    half, far = np.cos(0.4995 * angle), np.cos(1.501 * angle) if 1.501 * angle < np.pi else -2.0

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(a, 1024) for a in range(0, whole.num_rows, 1024)):
                alike = unit(matrix(batch.column(3), size)) @ centres.T
                at, home = np.arange(len(alike)), alike.argmax(axis=1)
                best = alike[at, home]
                visits = (best[:, None] - alike <= reach * apart[home]) & (np.arange(len(centres)) < home[:, None])
                who, cell = np.nonzero(visits)
                who, cell = np.concatenate([at, who]), np.concatenate([home, cell])
                role = np.where(np.arange(len(who)) < len(at), np.where(best[who] >= half, CORE, FRINGE), VISITOR)
                taken = batch.take(pa.array(who))
                extra = [pa.array(cell.astype(np.int32)), pa.array(role.astype(np.int32)), pa.array(alike[who, cell] >= far)]
                yield pa.RecordBatch.from_arrays([*taken.columns, *extra], ["class", "vec_id", "weight", "x", "cell", "role", "near"])

    kind = classes.schema["x"].dataType.simpleString()
    placed = classes.select("class", "vec_id", "weight", "x").mapInArrow(place, f"class bigint, vec_id bigint, weight bigint, x {kind}, cell int, role int, near boolean")
    placed = stage(placed, "cells")
    cores = placed.filter(F.col("role") == CORE)
    core = cores.groupBy("cell").agg(F.min("vec_id").alias("label"), F.sum("weight").alias("all"))
    cores = cores.join(core, "cell").select("class", "vec_id", (F.col("all") - F.col("weight")).alias("links"), "label")
    met = blocks(placed, chunk).groupBy("cell", "kind", "i", "j").applyInArrow(lambda t: product(t, size, least), FOUND)
    met = stage(met.unionByName(cores), "links")
    counts = met.groupBy("class").agg(F.sum("links").alias("links"))
    members = hashed.drop("x").join(classes.select("h1", "h2", "class", F.col("vec_id").alias("first"), "weight"), ["h1", "h2"], "left")
    members = stage(members, "members")
    twice = members.filter("class IS NOT NULL").groupBy("vec_id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi").select("vec_id")
    same = members.join(twice, "vec_id").select("vec_id", F.col("first").alias("label"))
    labels = components(met.select("vec_id", "label").unionByName(same), "vec_id", "label")
    out = members.join(counts, "class", "left").join(labels.withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce("label", "first", "vec_id")
    links = F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("bigint")
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
