"""Connected components of links between rows, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def _contract(pairs: DataFrame, keep: str) -> DataFrame:
    """Each neighbour that ``keep`` names, and the node itself, linked to the node's smallest neighbour.

    The minimum is a map-side aggregate, written before it is joined back, so that the rows of a node
    with very many neighbours can be split over tasks.
    """
    least = cut(pairs.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least")))
    back = pairs.join(least, "node").filter(keep)
    near = back.select(F.col("other").alias("b"), F.col("least").alias("a"))
    own = least.select(F.col("node").alias("b"), F.col("least").alias("a"))
    return cut(near.unionByName(own).filter("a <> b").distinct().select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (a, b: long, or structs that start with one): the smallest it can reach.

    Links may repeat, run either way or from a node to itself; nodes without a link to another are not
    returned.  Every round is written to the shared folder, so a lost executor costs one round's tasks.
    The number of rounds grows with the logarithm of the longest chain.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    edges = cut(links.filter("a <> b").select(least.alias("a"), most.alias("b")).distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        large = _contract(both, "other > node")
        down = large.select(F.col("b").alias("node"), F.col("a").alias("other"))
        edges = _contract(down, "true")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()))
