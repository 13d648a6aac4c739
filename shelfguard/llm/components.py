"""Connected components of a link table by alternating large and small stars.

Each half round turns every node's links towards its smallest neighbour; the table is
written to the shared folder in between, so lost executors cost one half round. Both
sides of every join are plain scans, so a node with very many links can be split at run
time. Rounds go on until nothing changes; what reaches the driver is a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfguard.llm.common import stage


def _towards_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m the smallest of u and all its v."""
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "star")
    return pairs.join(least, "u")


def _links(df: DataFrame) -> DataFrame:
    """Without loops and repeats, the larger node first."""
    return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link to another; component is its smallest node."""
    links = stage(_links(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    seen = None
    while True:
        # Large star: the larger neighbours of u move to the smallest.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(_links(large), "links")
        # Small star: u and its smaller neighbours move to the smallest.
        small = _towards_smallest(links)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        links = stage(_links(small), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    # Only stars are left: (node, its component's smallest node).
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
