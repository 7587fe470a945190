"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), each a written table.

A step gives every vertex its neighbourhood's least vertex by an aggregation with map-side combine, and joins that back;
no neighbourhood is ever collected. The number of rounds grows with the logarithm of the number of vertices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, written


def _least(edges: DataFrame) -> DataFrame:
    """edges u, v: each with m, the least of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return edges.join(least, edges["u"] == least["x"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Returns node, component (its least node) for each node of a link."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: neighbours above u go to the least; then small star: neighbours below u, and u, do.
        large = written(_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        small = _least(large)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small, "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        freed(edges.sparkSession)
        if now == before or not now.n:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
