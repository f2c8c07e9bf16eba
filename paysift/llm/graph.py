"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm.store import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long).

    ``component`` is the smallest node that can be reached. Alternates the
    large-star and small-star steps until the edge set stays the same, which
    takes a number of rounds that grows with the logarithm of the longest path.
    Each step is a minimum per node and a join, so a hub with many neighbours
    is pre-aggregated and its join rows can be split; only two numbers per
    round reach the driver. No edges give no rows; loops and repeats are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = checkpoint(e)
    before = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = (now["n"], now["h"])
        if now == before or now[0] == 0:
            break
        before = now
        # large star: link every larger neighbour of u to u's smallest neighbour (or u)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: link u and its smaller neighbours to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = checkpoint(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
