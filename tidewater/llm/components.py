"""Connected components of an edge table, by alternating star contraction.

Every round is two groupings and joins over the shrinking edge table: a large
star ties the larger neighbours of each node to its smallest one, a small star
the smaller ones.  Minima are combined before the shuffle and joins are left
to adaptive skew handling, so a node with a third of all edges does not land
in one task.  Rounds are cut by tables in the shared checkpoint folder, and end
as soon as the edges are stars, which one grouping by node tells.  Links that
are found later join the components themselves, not their nodes again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b; the same after one star operation."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    tied = near.join(least, near["a"] == least["u"])
    if large:  # repeated edges go with the small star
        return tied.filter(F.col("b") > F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Does every node have one smaller neighbour, or only larger ones?"""
    ends = (edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    other = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1")
    return other.agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); the component is its
    smallest node.  Loops and repeated edges do not matter; no edges, no rows."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _stars(now):
        now = stored(_star(_star(now, True), False), name)
    roots = now.select(F.col("b").alias("id")).distinct()
    return stored(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.select("id", F.col("id").alias("component"))), name)


def extended(first: DataFrame, late: DataFrame, name: str) -> DataFrame:
    """The components ``first`` (id, component) with further links ``late``
    (a, b), whose nodes may be new.  Only the components that late links join
    are contracted."""
    late = stored(late, name)
    one, two = (first.select(F.col("id").alias(x), F.col("component").alias(f"{x}_in")) for x in "ab")
    tied = late.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
    over = components(tied, name).select(F.col("id").alias("old"), F.col("component").alias("new"))
    moved = first.join(over, first["component"] == over["old"], "left").select("id", F.coalesce("new", "component").alias("component"))
    fresh = over.join(first, over["old"] == first["id"], "left_anti").select(F.col("old").alias("id"), F.col("new").alias("component"))
    return stored(moved.union(fresh), name)
