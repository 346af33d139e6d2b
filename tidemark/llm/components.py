"""Connected components by alternating large and small stars over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_stars(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "_u")
    return both.join(least, F.col("a") == F.col("_u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; edges run downwards."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "_u")
    joined = edges.join(least, F.col("a") == F.col("_u"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("_u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is its least node.

    Each round is written to the shared folder, so a lost executor costs one round.
    Nodes without an edge to another node are left out; no edges give no rows.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(down.filter("a > b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        wide = _large_stars(now).filter("a > b").distinct()
        now = stored(_small_stars(wide).filter("a > b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
