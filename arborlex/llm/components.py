"""Connected components of a link table by alternating large-star and small-star steps.

Links stay distributed throughout.  Each step is a partial aggregate (the smallest neighbour
of a node) and an equi-join back on the node, which Spark's adaptive plan can split for a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked with the node's smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both).withColumn("m", F.least("m", "u"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node (u > v in every link) and its smaller neighbours are linked with the smallest."""
    low = _smallest(links)
    return (links.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where(F.col("u") > F.col("v")).distinct())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` but the roots themselves; the root is the
    smallest node of the component.  Nodes may be of any ordered type.

    Links with a null end and self-links are ignored; repeated links count once; no links give
    an empty table.  Rounds end when a round changes nothing, which the count and hash sum of
    the links tell; the number of rounds grows with the logarithm of the largest component.
    """
    links = written(links.where("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        links = written(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
