"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import Shelf


def _least(edges: DataFrame) -> DataFrame:
    """For each ``u`` the least of its ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, shelf: Shelf) -> DataFrame:
    """``node, component`` of every node that has a link in ``links(a, b)``; the component is its least node.

    Large-star: every node hands its larger neighbours to the least node it knows. Small-star: every node hands itself
    and its smaller neighbours to the least of them. Both in turn until nothing changes, which they reach after a number
    of rounds in the square of the logarithm of the nodes. The least neighbours are written out before the join with
    them, so that the join can split a node of many edges; what a round no longer reads is deleted.
    """
    edges = shelf.put(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen, now = None, _fingerprint(edges)
    while now[0] and now != seen:
        seen = now
        least = shelf.put(_least(_both(edges)))
        large = shelf.put(_both(edges).join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        shelf.drop(edges, least)
        least = shelf.put(_least(large))
        near = large.join(least, "u")
        edges = shelf.put(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.toDF("u", "v")).distinct())
        shelf.drop(large, least)
        now = _fingerprint(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
