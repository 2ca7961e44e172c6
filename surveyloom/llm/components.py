"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import join_groups, stored


def _star(edges: DataFrame, n_edges: int, large: bool) -> DataFrame:
    """Hang the neighbours of each vertex on the least vertex around it: the greater ones (large star), or the smaller ones and the vertex itself (small star)."""
    around = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # a < b
    if large:
        around = around.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # Stored, as the join reads it three times: its plan in each of them is more than the driver should hold.
    least = stored(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree")), "least")
    joined = join_groups(around, least, ["u"], "degree", 2 * n_edges)  # a vertex of many edges isn't gathered in one task
    pairs = joined.filter(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        pairs = pairs.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return stored(pairs.filter(F.col("a") < F.col("b")).distinct(), "stars")


def _unfinished(edges: DataFrame) -> tuple[int, int]:
    """Edges (a, b), a < b, and the vertices that keep them from being stars around their least ones: those with several smaller neighbours, or with both smaller and greater ones."""
    ends = edges.select(F.col("b").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(edges.select(F.col("a").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    each = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return tuple(each.agg(F.coalesce(F.sum("below"), F.lit(0)), F.count_if(F.col("below") + F.col("above") > 1)).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for each id on an edge (a, b) the least id reachable.  Loops and repeated edges are ignored; no edges give no rows."""
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") < F.col("b")).distinct(), "edges")
    # Each step is a plan that the driver holds; edges that are stars already need none.
    while (now := _unfinished(edges))[1]:
        edges = _star(_star(edges, now[0], True), now[0], False)
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
