"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import forget, written


def _stars(edges: DataFrame) -> DataFrame:
    """One round, written: every node's larger neighbours, then all its neighbours, are tied to the smallest one near it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written tables, so that the joins aren't bound to the aggregates' partitions and hot nodes may be split
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
    smallest = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
    small = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = written(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "stars")
    forget(least, large, smallest)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (a, b); root is the smallest node that it can reach, and roots have no row of their own.

    Alternating large and small stars: each round is a minimum by key (combined before the shuffle) and a join whose hot keys
    may be split, so a node with many neighbours needs no task of its own. Every round is written to the shared folder, and the one before deleted; the rounds
    grow with the logarithm of the largest component and stop when the edges don't change.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    sign = None
    while True:
        was, sign = sign, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == was or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, now = now, _stars(now)
        forget(before)
