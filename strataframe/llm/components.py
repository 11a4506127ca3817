"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import written


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(a, m): the smallest node among a and its partners. Pre-aggregated before the shuffle."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Join each a's least partner to those partners that ``keep`` selects. A hot a is a skewed
    sort-merge join, which adaptive execution splits."""
    joined = pairs.join(_least_neighbour(pairs), "a")
    return joined.where(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges(a, b)``; root is the smallest node it reaches.

    Each round joins a node's larger partners to its least partner, then its smaller partners;
    rounds of this kind need about log(n) steps. It ends when a round changes no edge. Every
    round is a written table; only a count and a checksum reach the driver. Nodes must not be
    null; self-loops are ignored; an empty table gives an empty table.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a")).unionByName(
            _least_neighbour(both).where("m < a").select("a", F.col("m").alias("b")))
        large = written(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b"))
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      "small-star")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(
        now.select("b").distinct().join(roots, F.col("b") == F.col("a"), "left_anti")
        .select(F.col("b").alias("node"), F.col("b").alias("root")))
