"""Connected components of links between 64-bit ids, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.scratch import drop, stored


def _least(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours, as a table: Spark then sizes the join with it, and can split a hub."""
    found = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.sparkSession.read.parquet(stored(found, "least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    across = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return across.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links to (node, root): the smallest id of each linked node's component.

    Nodes without a link, links of a node to itself and links with a null are not in the
    result.  Repeated links count once.  Every round writes its links to the shared
    folder, which cuts the lineage; the driver sees only a count and a checksum.  The
    number of rounds grows with the logarithm of the longest chain.
    """
    spark = edges.sparkSession
    path = stored(edges.select("u", "v").filter("u <> v").distinct(), "links")
    before = None
    while True:
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = tuple(state)
        following = stored(_small_star(_large_star(now)), "links")
        drop(spark, path)
        path = following
