"""Connected components of an undirected graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.session import discard, stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has an edge to another one.

    Every round ties each node's neighbours to its smallest neighbour: first the larger ones, then the smaller ones
    (Kiveris and others, "Connected components in MapReduce and beyond"). The number of rounds grows with the logarithm
    of the graph, not with the length of a chain. Neighbours are never gathered into a list: a hub is an aggregate and a
    join. Each round is written, so a lost executor costs a re-read.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = stage(now, "components")
    while not _only_stars(now):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above u hang from the smallest of u and its neighbours
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its neighbours below hang from the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        before, now = now, stage(hung.where("u <> v").distinct(), "components")
        discard(before)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node hangs from one root that hangs from nothing."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    seen = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return seen.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()
