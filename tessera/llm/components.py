"""Connected components of a link table, by alternating star operations on Spark.

Every round points each node's larger neighbours at its smallest one (large star), then each
node and its smaller neighbours at the smallest of them (small star). The edge table ends as one
star per component around its smallest node, after a number of rounds that grows with the
logarithm of the nodes. Each round is written to the shared folder; nothing but a count and a
checksum of the edges comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star_round(edges: DataFrame) -> DataFrame:
    """``edges (u > v)`` after a large and a small star."""
    both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (both.filter(F.col("v") > F.col("u")).join(least, "u")
             .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(small, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", "m")).distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every node that has a link to another: ``root`` is its component's smallest node."""
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = written(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = state(edges)
    while before[0]:
        edges = written(_star_round(edges))
        now = state(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select("v", "v").distinct()))
