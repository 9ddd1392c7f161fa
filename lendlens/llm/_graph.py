"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as S


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``, the component named by
    its smallest node.

    Alternates large-star and small-star steps: every node links its larger
    neighbours, then its smaller ones, to the smallest node it knows. Each
    round aggregates map-side (a node with very many neighbours is one partial
    row per task) and is written to the shared folder, so the lineage stays
    short; long chains take a number of rounds logarithmic in their length.
    """
    u, v = F.col(a), F.col(b)
    now = S.materialised(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                         .where("u > v").distinct(), "components")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if before == state or state["n"] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = S.materialised(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = S.materialised(
            large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
