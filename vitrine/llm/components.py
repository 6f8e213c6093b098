"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.core import discard, stored


def _smallest(links: DataFrame) -> DataFrame:
    """(a, low): each node's smallest neighbour, itself included."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link (a, b); component: the smallest node reachable.

    The result is read from one stored table, which ``discard`` deletes.

    Each round turns the links of a node towards its smallest neighbour: first those to larger neighbours, then those
    to smaller ones. Rounds are written to the shared folder and end when both ends of every link bear one name; a component
    of n nodes takes in the order of log n rounds. Minima are taken before rows move, so a node with very many links is no
    hot spot.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    now = links
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(_smallest(both), "large-star")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stored(large, "links")
        before, wide = now, low
        low = stored(_smallest(large), "small-star")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        now = stored(small.where("a <> b").distinct(), "links")
        discard(wide, large, low, *[before] * (before is not links))
        names = now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
            now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        # A node that still points to two others has two names, of which one differs from its neighbour's.
        one = links.join(names.withColumnRenamed("component", "x"), F.col("a") == F.col("node")).select("a", "b", "x")
        two = one.join(names.withColumnRenamed("component", "y"), F.col("b") == F.col("node")).where("x <> y")
        if two.isEmpty():
            discard(links)
            names.stored_at = now.stored_at
            return names
