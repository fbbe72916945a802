"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.tables import stored


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours move to the smallest of them (or the node itself).

    The smallest is found with partial sums before the shuffle, and joined back:
    a hub with very many neighbours is split by the skew handling of the join.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = edges.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is a component's smallest node.

    Every round is written to the shared folder, so the plan stays short and a
    lost executor repeats one round at most. Rounds end when nothing moves;
    their number grows with the logarithm of the longest path.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(pairs.distinct(), "edges")
    mark = None
    while True:
        now = stored(_starred(_starred(now, large=True), large=False), "edges")
        row = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                      F.sum(F.xxhash64("a", "b") % 1000003).alias("s")).collect()[0]
        if row == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = row
