"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm.common import discard, materialize


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """Hook each node's larger (or no larger) neighbours to the least node about it.

    The least neighbour comes from a grouped aggregate (combined before its
    shuffle) joined back to the edges, so a hub is never gathered in one row.
    """
    if large:
        edges = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
    joined = edges.join(low, edges["u"] == low["w"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of a link: the least node that links reach.

    Each round is written to the shared folder; rounds go on until the edges
    stop changing, a number that grows with the logarithm of the longest path.
    Nulls and links of a node to itself are left out.
    """
    spark = links.sparkSession
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    seen = None
    while True:
        before, edges = edges, materialize(_star(_star(edges, large=True), large=False), spark, "stars")
        if seen is not None:
            discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
