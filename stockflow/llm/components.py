"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every neighbour that is larger than a node on that node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("b"), F.least("m", "u").alias("a")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a > m").select(F.col("a").alias("b"), F.col("m").alias("a"))
    return moved.union(least.select("b", F.col("m").alias("a"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node on a link; the component is its smallest node.

    ``edges`` has numeric columns a and b; null ends and loops are ignored.
    Each round is two shuffled aggregates with their joins and is written to the
    shared folder; a hub is split by adaptive execution, as the joins are on the
    link table. Rounds stop when the table no longer changes, after a number of
    rounds that grows with the logarithm of the longest chain.
    """
    now = stored(
        edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    mark = F.struct(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
    before = now.select(mark).first()[0]
    while before[0]:
        now = stored(_small_star(_large_star(now).select("a", "b")).select("a", "b"), "links")
        after = now.select(mark).first()[0]
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a"), F.col("a")).distinct()
    )
