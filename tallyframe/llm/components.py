"""Connected components by alternating stars over an edge table; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b) but the roots; root is the smallest node of the component.

    Each round links the larger neighbours of a node to its smallest one, then
    the smaller ones; minima are aggregated before the shuffle, so a node with
    very many edges is no single task's work. Rounds grow with the logarithm of
    the longest path. Self links and repeated links do not matter.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.where("a <> b").select(a, b).distinct(), "edges")
    state = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("_u")).agg(F.min("b").alias("m"))
        large = both.join(least, F.col("a") == F.col("_u")).where("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("_u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("_u")).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        rest = least.select(F.col("_u").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(rest).where("a <> b").distinct(), "edges")
        before, state = state, _fingerprint(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)
