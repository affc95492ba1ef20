"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.workspace import settle


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node of its component) for every node of links (a, b); both bigint.

    Each round hangs neighbours under the smallest one known, for larger neighbours and then for smaller ones, until
    every edge leads to a root. Nothing but a count and a sum per round reaches the driver.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _hang(both, larger=True)
        edges = settle(_hang(edges, larger=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return settle(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components")


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: the larger neighbours of each node go to its smallest neighbour (or itself). Small star: the smaller
    neighbours of each node, and the node, go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    joined = edges.join(least, "a")
    if larger:
        pairs = joined.where("b > a").select(F.col("b").alias("x"), "low")
    else:
        own = least.select(F.col("a").alias("x"), "low")
        pairs = joined.select(F.col("b").alias("x"), "low").unionByName(own)
    return pairs.where("x <> low").select(F.col("x").alias("a"), F.col("low").alias("b")).distinct()
