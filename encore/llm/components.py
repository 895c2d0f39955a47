"""Connected components by alternating large-star and small-star.

Each round is two aggregations and joins over the edge list; a node of any
degree meets in one task only as its partial minimum.  Edges are written to
the shared folder after every round, so a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)``: each node of an edge that is not its component's smallest
    node, with that smallest node.  Self edges and null ends are ignored."""
    edges = materialize(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen, now = None, _state(edges)
    while now != seen:
        large = _large_star(edges).distinct()
        edges = materialize(_small_star(large).where("u != v").distinct(), "edges")
        seen, now = now, _state(edges)
    return edges
