"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; ``root`` is the least node of its component."""
    found = stars(links, label)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def stars(links: DataFrame, label: str = "components") -> DataFrame:
    """``components`` without the rows of the roots themselves.

    Alternates large-star and small-star steps: every node hangs its larger
    neighbours, then its smaller ones, under the least node it knows.  The
    links become a star per component after a number of rounds that grows with
    the logarithm of the component.  Every round is a pre-aggregated minimum
    and a join, written to the shared folder; a node with very many links is
    split by AQE.  Links that come twice go with the round's one distinct.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges, label)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), label)
        # done when no node hangs under two, and none that hangs has others under it
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up + down > 1 and up > 0").limit(1).count() == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
