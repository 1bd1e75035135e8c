"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import written


def _lowest(edges: DataFrame) -> DataFrame:
    """The least neighbour of every `u`, stored so that the join that follows may split a hub's rows."""
    return written(edges.groupBy("u").agg(F.min("v").alias("least")), "lowest")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_lowest(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = _lowest(edges)
    moved = edges.join(lowest, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("least").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart without moving them."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor(h)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) for every node of a link; root is the least node it can reach.

    Loops and repeated links change nothing, an empty table gives an empty one. Every round stores its edges, of which
    there are never more than at the start. No task holds a component: minima are summed up before the shuffle, and the
    joins are such that Spark can split a hub.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "edges")
    before, after = None, _mark(edges)
    while before != after and after[0]:
        large = written(_large_star(edges), "large")
        edges = written(_small_star(large), "small")
        before, after = after, _mark(edges)
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select("root").distinct().select(F.col("root").alias("node"), "root"))
