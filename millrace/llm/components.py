"""Connected components of an edge table, as joins and aggregates that halve the paths in every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of each id of ``edges`` (a, b; longs): id, component.

    Alternating large-star and small-star rounds: every node hands its neighbours to the smallest one it sees, so a round
    has as many rows as the one before and a hub is only ever an aggregate with a partial sum, never a list. The
    number of rounds grows with the logarithm of the longest path. Null ends are left out; ids without an edge to another
    id are left out too.
    """
    now = settle(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter(
        "a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        # Large star: for each node, the larger neighbours point to the smallest of node and neighbours.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: for each node, itself and the smaller neighbours point to the smallest of them.
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small_least, "a")
        now = settle(linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small_least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node either points to one node or is pointed at: then the components are found."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down + up > 1").isEmpty()
