"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verigrid.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with v < u.

    Large: every node hands its smallest neighbour (or itself) to its larger neighbours. Small:
    every node hands its smallest smaller neighbour to the others and keeps an edge to it.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    met = near.join(least, near["u"] == least["w"])
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) for every node of a link that is not smallest itself.

    Links are undirected; repeated links and links of a node to itself do no harm. Each round is
    written to the shared folder, so a lost executor costs one round; rounds grow with the logarithm
    of the number of nodes.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stage(pairs, "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state["n"] == 0 or (state["n"], state["x"]) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = (state["n"], state["x"])
        edges = stage(_star(_star(edges, True), False), "links")
