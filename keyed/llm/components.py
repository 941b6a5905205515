"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import cut


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(links.select(F.col("v").alias("a"), F.col("u").alias("b")))


def _star(arrows: DataFrame, keep: str) -> DataFrame:
    """Links every kept neighbour of a node, and the node, to the least of them and it."""
    # written, so that the join reads two plain shuffles, which Spark can split at a node with very many links
    least = cut(arrows.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    joined = arrows.join(least, "a")
    moved = joined.filter(keep).select(F.col("b").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("a").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(own).filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (u, v) of comparable ids: every node that has one, with the least node it reaches. Columns: node, component.

    Each round links larger neighbours to the least neighbour, then smaller ones, until nothing changes; trees become stars
    in a number of rounds that grows with the logarithm of the longest path. Only (id, id) rows move, minima are taken
    before the shuffle, a node with very many links is left to the skewed-join split, and each round is written to the
    shared folder. Self-links and repeats are dropped; no links give no rows.
    """
    now = cut(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        large = _star(_both(now), "b > a")
        small = _star(large.select(F.col("u").alias("a"), F.col("v").alias("b")), "true")
        now = cut(small, "stars")
        at = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if at == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = at
