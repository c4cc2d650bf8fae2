"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isospread.sources.storage import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with an edge.

    ``edges`` has the long columns ``a`` and ``b``. Edges from a node to itself are ignored.
    Each round hangs every node's neighbours on the least of them, first the larger ones and then
    the smaller ones, until nothing changes; rounds grow with the logarithm of a component's
    size. Each round is written to the shared folder, so its lineage ends there; only counts
    reach the driver.
    """
    state = settle(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if mark == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select("b", "b").distinct()
            )
        before = mark
        state = settle(_small_star(_large_star(state)))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.join(least, "a")
        .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (
        joined.select("a", F.col("m").alias("b"))
        .union(joined.select(F.col("b").alias("a"), F.col("m").alias("b")))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )
