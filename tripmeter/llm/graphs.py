"""Connected components of a table of links, by alternating star contractions.

Each round links every node to the smallest neighbour it knows of, first for larger neighbours,
then for smaller ones; the number of rounds grows with the logarithm of the longest chain.  Only
minima travel per node, combined before the shuffle, so a node with very many links is no burden.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _toward_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with the smallest of each u and its v as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame, scratch: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b): the root is the component's smallest node.

    Null ends and links to itself are ignored; links may repeat and go either way.  Every round is
    written to ``scratch``, a folder that all executors share.
    """
    spark = links.sparkSession
    turned = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    path = f"{scratch}/round-0"
    turned.write.parquet(path)
    known, number = None, 0
    while True:
        edges = spark.read.parquet(path)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == known or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        known, number = state, number + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _toward_least(large)
        joined = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        path = f"{scratch}/round-{number}"
        joined.where("u <> v").distinct().write.parquet(path)
