"""Connected components of a large graph by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import stored

#: Rounds after which something is wrong: a chain of n nodes needs about log n.
MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link to a smaller one; the component is its smallest node.

    In each round every node hands its larger neighbours, then its smaller
    ones, to the smallest node next to it. Smallest neighbours are found by
    map-side combined minima, and the join that hands neighbours over is one
    that Spark can split where a node has very many. Each round is written to
    the shared folder, which also ends its lineage. Stops when nothing moves.
    """
    edges = links.select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v").distinct()
    edges = stored(edges, "links")
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour, or to itself if it is smaller than all."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m"))
    larger = edges.select(F.col("v").alias("c2"), F.col("u").alias("larger"))
    return larger.join(least, F.col("c2") == F.col("c")).select(
        F.col("larger").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.select(F.col("u").alias("c"), F.col("v").alias("smaller"))
    handed = smaller.join(least, F.col("c") == F.col("u")).select(F.col("smaller").alias("u"), F.col("m").alias("v"))
    return handed.where("u > v").union(least.select("u", F.col("m").alias("v"))).distinct()
