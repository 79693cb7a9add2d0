"""Distributed union-find: connected components of an edge table.

Method: alternating large-star and small-star steps. Each step links the neighbours of a node to the smallest
of them, until every node hangs directly below its component's smallest node, which is looked at before each step.
Minima are taken by map-side combined aggregation and joined back from written tables, so a node with very
many edges is split like any skewed join key. Nothing but one row per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _settled(edges: DataFrame) -> bool:
    """Whether every upper end has one edge and is no lower end: then all hang directly below their smallest node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("x"))
    sums = ends.groupBy("x.node").agg(F.sum("x.up").alias("ups"), F.min("x.up").alias("least"))
    return sums.where("ups > 1 or ups = 1 and least = 0").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link to another; root is the smallest node of its component.

    Links are undirected; repeated links, links to itself and links with a null are allowed and ignored.
    """
    links = links.where(F.col(a) != F.col(b))
    edges = keep(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "lowest")
        large = keep(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        lowest = keep(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        moved = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(moved.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "small-star")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
