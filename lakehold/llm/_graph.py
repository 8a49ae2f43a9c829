"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a minimum per node (pre-aggregated before the shuffle) joined back to the edges. The
edge list never grows, no task holds the edges of one node, and each round's edges are written to
the shared folder, which cuts the lineage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.sources.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges, undirected -> ``(node, component)``: the smallest node reachable.

    Nulls, loops and repeated edges add nothing; nodes without an edge to another are not listed.
    """
    edges = edges.select("u", "v").where("u <> v")
    down = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(down):
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        # a node that is its own minimum keeps its edges to the larger neighbours
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
    return down.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        down.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(down: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none: the steps change nothing any more."""
    ends = down.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("n")), F.struct(F.col("v").alias("node"), F.lit(0).alias("n")))).alias("e"))
    nodes = ends.select("e.*").groupBy("node").agg(F.sum("n").alias("up"), F.min("n").alias("centre"))
    return not nodes.agg(F.count_if(F.expr("up > 1 or (up = 1 and centre = 0)"))).first()[0]


def joined(member: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of a graph, known as (node, component), with more edges: only these, between components, are gone through."""
    of = lambda c: member.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    edges = edges.select("u", "v").where("u <> v")
    named = edges.join(of("u"), "u", "left").join(of("v"), "v", "left").select(
        "u", "v", F.coalesce("of_u", "u").alias("of_u"), F.coalesce("of_v", "v").alias("of_v"))
    named = materialise(named, "edges")
    moved = components(named.select(F.col("of_u").alias("u"), F.col("of_v").alias("v"))).select(F.col("node").alias("component"), F.col("component").alias("to"))
    ends = named.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("of_u").alias("component")),
                                          F.struct(F.col("v").alias("node"), F.col("of_v").alias("component")))).alias("e"))
    nodes = member.unionByName(ends.select("e.*")).distinct()
    return materialise(nodes.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "components")
