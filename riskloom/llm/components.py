"""Connected components by alternating large and small stars.

Each round points every node's larger neighbours, then its smaller ones, at the
smallest node it knows, until only stars are left: O(log² n) rounds of two
grouped minima and two joins. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from larger ``u`` to smaller ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the component's smallest node, itself included.
    ``edges`` has two long columns; loops and repeated edges do no harm; no edges give no rows."""
    u, v = edges.columns
    now = stored(
        edges.filter(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    sign = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = sign(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "stars")
        before, seen = seen, sign(now)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
