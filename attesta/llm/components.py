"""Connected components of a table of links, by alternating large-star and small-star steps.

Nothing is collected: the driver sees only a count and a checksum for each round. Each step's minima are staged, so
the join back on a hub's key gets its own exchange on both sides, which adaptive execution splits when the hub is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import drop, stage


def connected(spark: SparkSession, links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, component (the smallest node that links reach) for every node of links(a, b); loops and repeats are fine.

    Both columns have one type with an order. Rows with a null end are ignored. Raises if max_rounds do not suffice;
    the number of rounds is logarithmic in the longest chain.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stage(spark, ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u, and u itself, goes to u's smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(spark, both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "cc-large")
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        old, edges = [edges, low], stage(spark, large, "cc-edges")
        drop(spark, *old)
        # small star: every smaller neighbour of u, and u itself, goes to the smallest of them
        low = stage(spark, edges.groupBy("u").agg(F.min("v").alias("m")), "cc-small")
        small = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        old, edges = [edges, low], stage(spark, small, "cc-edges")
        drop(spark, *old)
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.count_distinct("u").alias("d")).first()
        if now["n"] == now["d"] and before == (now["n"], now["x"]):
            break
        before = (now["n"], now["x"])
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
