"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelflux.llm.store import settle


def _stars(edges: DataFrame) -> bool:
    """Whether each node with an edge to a smaller node has no other edge; edges (a, b) are distinct and a > b."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")).where("up > 0 and n > 1").isEmpty()


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of the component.

    Each step joins edges with one row a node, its smallest neighbour, so a node with very many edges is one
    skewed key that adaptive execution splits. Steps end when the edges are stars, which may be at once; if `rounds`
    are given and run out before that, it is an error.

    Defined cases: an edge of a node with itself and repeated edges change nothing; edges with a null end are left out;
    a node that only has an edge with itself does not appear; no edges give no rows; other columns are ignored.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for done in count():
        if _stars(now):
            break
        if rounds is not None and done >= rounds:
            raise RuntimeError(f"components still change after {rounds} rounds")
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = settle(small.where("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
