"""Connected components of an edge table by alternating large and small stars.

Each round links every node to the smallest node among its neighbours, first
the larger neighbours, then the smaller ones; the edges end as one star per
component around its smallest node.  All state stays in distributed tables;
each round is written to the shared folder, and the minima are written before
they are joined, so that both sides of that join are plain shuffles and a node
with very many neighbours is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _to_smallest(links: DataFrame) -> DataFrame:
    """``links`` (x, y) with the smallest y of each x as ``m``, or x if that is smaller."""
    smallest = stored(links.groupBy("x").agg(F.min("y").alias("m")), "smallest")
    return links.join(smallest.withColumn("m", F.least("x", "m")), "x")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none if it is one itself."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    )
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter("up > 1 OR (up > 0 AND root > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``u``, ``v``) but the components' smallest ones.

    ``component`` is the smallest node that can be reached.  Loops and repeated
    or reversed edges are ignored; edges with a null end are dropped.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(now, "edges")
    while not _is_star_forest(now):
        both = now.selectExpr("u AS x", "v AS y").unionByName(now.selectExpr("v AS x", "u AS y"))
        large = _to_smallest(both).filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        near = _to_smallest(stored(large, "large"))
        now = near.selectExpr("y AS u", "m AS v").filter("u <> v").unionByName(near.selectExpr("x AS u", "m AS v")).distinct()
        now = stored(now, "edges")
    return now.selectExpr("u AS node", "v AS component")
