"""Connected components of a relation of links, whatever the number of links of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartloom.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for every key with a link but each component's smallest, which is its root.

    Each round joins every node's larger neighbours to its smallest one (large star), then its smaller
    ones (small star). The smallest neighbours are written before they are joined, so both sides of a
    join are plain shuffles, and Spark can split the partition of a node that has very many links.
    Rounds grow with the logarithm of a chain's length.
    """
    edges = edges.select(F.greatest("key", "root").alias("a"), F.least("key", "root").alias("b"))
    edges = stored(edges.where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large")
        down = stored(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionAll(down.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("key"), F.col("b").alias("root"))
        before = now
