"""Connected components of a distributed list of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b) hung on the least neighbour: of every node (large), or of each node among those below it."""
    sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    hung = sides.join(least, sides["a"] == least["u"])
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of any direction to (node, component): the least node that each node reaches.

    Nodes without a link to another node are left out; no links, no rows. Each round is a written table. Rounds
    grow with the logarithm of the longest path; nodes with many links are counted map-side and split by AQE.
    """
    with Scratch(links.sparkSession) as scratch:
        return _rounds(links, scratch)


def _rounds(links: DataFrame, scratch: Scratch) -> DataFrame:
    links = scratch(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark or now[0] == 0:
            return written(links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct()))
        mark, before = now, links
        links = scratch(_star(_star(links, large=True), large=False))
        scratch.drop(before)
