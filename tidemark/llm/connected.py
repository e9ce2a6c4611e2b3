"""Connected components by alternating large-star and small-star rounds.

Each round is a few joins and aggregates on the links; it is written to the
shared scratch folder, which keeps the plan short.  Every node ends linked to
the smallest node of its component.  Rounds grow with the logarithm of the
longest chain.  A node with very many links is a min() with map-side combine,
and one skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.expr("hi % 1000003"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node but the roots, for ``links`` (a, b) of longs in any order, repeats allowed."""
    links = saved(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
                  "links")
    before, now = None, _state(links)
    while now != before:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(links.select("lo", "hi"))
        # written before it is joined: adaptive execution splits a hot key only between plain exchanges
        first = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-least")
        # large star: the larger neighbours of each node go to its smallest
        large = both.join(first, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        old, links = (links, first), saved(small.where("hi <> lo").distinct(), "links")
        for table in old:
            discard(table)
        before, now = now, _state(links)
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
