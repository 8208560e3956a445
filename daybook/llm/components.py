"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daybook.llm.frames import stored


def _large(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the join rests on plain shuffles, of which Spark splits a hot node's part.
    least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("__least")), "least")
    return both.join(least, "a").where("b > a and b <> __least").select(F.col("b").alias("a"), F.col("__least").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("__least")), "least")
    own = least.select("a", F.col("__least").alias("b"))
    others = edges.join(least, "a").where("b <> __least").select(F.col("b").alias("a"), F.col("__least").alias("b"))
    return own.unionByName(others)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of `edges` (a, b) but the roots, the smallest of their component.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest
    path. Only a count and a sum of each round reach the driver.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stored(ordered, "edges"), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        now = stored(_small(_large(now)).distinct(), "edges")
