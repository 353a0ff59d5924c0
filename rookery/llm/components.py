"""Connected components of an edge table by alternating stars: every round is two grouped minima and two equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.workspace import stage


def _pull(pairs: DataFrame) -> DataFrame:
    """For directed (u, v): hang each v, and u itself, on the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    joined = pairs.join(least, "u")
    hung = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = least.select("u", F.col("low").alias("v"))
    return hung.union(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (u, v) reaches; nodes without an edge are not listed.

    Rounds end when the edges no longer change; their number grows with the logarithm of the longest chain. Every round
    is written, so a lost executor costs no more than a round. Null ends and loops are ignored; an empty table gives an
    empty one.
    """
    current = stage(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both).where("u > v")
        downward = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        current = stage(_pull(downward), "edges")
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
