"""Connected components of a graph given as a table of links, by large-star and small-star steps.

Each step is a minimum per node and a join; the tables between steps are written to the shared folder, so a
step never depends on more than one earlier one. The number of steps grows with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vedrina.shared import new_path, written


def _tallied(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links, written, and a fingerprint of their set."""
    links = written(links.distinct(), new_path(links.sparkSession, "links"))
    tally = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return links, tuple(tally)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    least = written(least, new_path(links.sparkSession, "least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = written(links.groupBy("u").agg(F.min("v").alias("m")), new_path(links.sparkSession, "least"))
    joined = links.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    ).filter("u <> v")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node that has a link to another.

    Links with a null end, and links of a node to itself, link nothing.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    links, tally = _tallied(links)
    while True:
        links, now = _tallied(_small_star(_large_star(links)))
        if now == tally:
            break
        tally = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
