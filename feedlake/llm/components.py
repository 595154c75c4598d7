"""Connected components by alternating large-star and small-star steps.

Each round replaces edges by edges to smaller neighbours, first among larger neighbours, then
among smaller ones, until every node points straight at the smallest node of its component.
Rounds grow with the logarithm of the longest chain.  The smallest neighbour of a node is an
aggregate that combines before the shuffle, and its join back can be split, so a node with
very many neighbours does no harm.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import remove, store


def _smallest(edges: DataFrame) -> DataFrame:
    """Each edge from ``a`` with ``m``, the smallest of ``a`` and its neighbours."""
    # Shuffled anew, since AQE splits a hot node only where both sides come straight from a shuffle.
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).hint("rebalance")
    return edges.join(least, "a")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _smallest(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = _smallest(large)  # all edges of ``large`` lead to a smaller node
    two = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return small.select(F.explode(two).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one edge and leads to a node that leads nowhere."""
    role = lambda name, leads: F.struct(F.col(name).alias("node"), F.lit(leads).alias("leads"))
    roles = edges.select(F.explode(F.array(role("a", 1), role("b", 0))).alias("r"))
    ends = roles.groupBy("r.node").agg(F.sum("r.leads").alias("edges"), F.min("r.leads").alias("least"))
    return ends.filter("edges > 1 OR (edges = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, of all nodes that have an edge.

    ``edges`` has two columns of one ordered type; loops, nulls and repeated edges are dropped.
    """
    pairs = edges.toDF("x", "y").filter("x <> y")
    tidy = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    now = store(tidy.distinct(), "edges")
    while not _is_done(now):
        after = store(_round(now), "edges")
        remove(now)
        now = after
    root = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.toDF("node", "component").unionByName(root)
