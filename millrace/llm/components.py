"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import stored


def components(links: DataFrame) -> DataFrame:
    """Nodes ``node`` with the smallest node of their component, ``root``; links have ``a`` and ``b``.

    Large and small stars in turn, until nothing changes: each turn moves every node to the smallest neighbour known,
    so the number of turns grows with the logarithm of the longest path. Every turn is a stored table; a node with
    very many links is only ever aggregated on the map side or split by the join.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(edges_of(large.unionByName(least.where("a > low").select("a", F.col("low").alias("b")))), "large")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(edges_of(small.unionByName(least.select("a", F.col("low").alias("b")))), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def edges_of(df: DataFrame) -> DataFrame:
    return df.where("a <> b").distinct()
