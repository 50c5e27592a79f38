"""Connected components of a link table, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node.

    ``links`` has two columns ``a`` and ``b`` of one type; direction, repetition and loops
    do not matter. Returns ``node, component``, a row per node that occurs in a link to
    another node. No links give no rows.

    Every round points each node's larger neighbours at its smallest one (large star) and
    then its smaller neighbours and itself at the smallest of them (small star); what
    changed is counted, and the rounds end when nothing did: as many as the logarithm of
    the longest chain. The minima are combined before the shuffle, and the join back to the
    links is an ordinary equi join whose hot keys AQE splits, so a hub with a third of all
    links meets in no single task. Each round is cut by checkpoint().
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").checkpoint()
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        new = small.checkpoint()
        # A forest of stars is the end: no node has two links up, or links both up and down.
        ends = new.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(new.select("b", F.lit(0)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
        links = new
        if not ends.where("up > 1 or up = 1 and least = 0").take(1):
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
