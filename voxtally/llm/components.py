"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of ``edges`` (``a``, ``b``).

    Alternates two steps until nothing changes: every node's larger neighbours move to its smallest neighbour, then every
    node and its smaller neighbours do.  The number of rounds grows with the logarithm of the longest chain.
    Each round is a written table, and the driver sees only its size and a checksum.
    """
    current = scratch.land(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        following = scratch.land(moved.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct(), "edges")
        scratch.drop(current)
        now = following.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        current = following
        if now == seen:
            break
        seen = now
    # Every other node now has one edge, to its root.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
