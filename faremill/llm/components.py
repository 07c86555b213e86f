"""Connected components of a link table, as a few Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import saved


def components(links: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
    """Every linked node with the smallest node of its component.

    ``links`` has columns a and b of one orderable type. Each round moves all links of a node to its smallest
    neighbour (star contraction): large stars on the greater neighbours, then small stars on the others. No list of
    neighbours is gathered; a hub's minimum is folded before the shuffle. Rounds grow with the logarithm of the
    longest path. Null ends and self-links link nothing; without links the result is empty.
    """
    edges = saved(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hops = large.join(low, "u")
        small = hops.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = saved(small.where("u <> v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.countDistinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias(node), F.col("v").alias(label)).union(
                edges.select(F.col("v").alias(node), F.col("v").alias(label)).distinct()
            )
        before = state
