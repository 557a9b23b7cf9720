"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import written


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v")))


def _shape(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``: root is its component's smallest node.

    The number of rounds grows with the logarithm of the longest path; each
    round is two aggregations with partial sums and two joins that AQE can
    split, and is written to the shared folder.  No edge reaches the driver.
    """
    now = written(_directed(edges), "components")
    shape = _shape(now)
    while True:
        now = written(_directed(_small_star(_directed(_large_star(now)))), "components")
        before, shape = shape, _shape(now)
        if shape == before:
            break
    # at the fixed point every edge is (node, root)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
