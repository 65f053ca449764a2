"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Size and hash of an edge set: one row."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with an edge; root is the least node it can reach, itself for a root.

    Edges (a, b) join two nodes, in either order and as often as they come. Each round links
    the larger neighbours of a node, then its smaller ones, to the least among them, until the
    edges are stars. Minima are taken before the shuffle and written before they are joined, so that Spark
    can split the edges of a node that has very many. Rounds are written tables.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(edges.select(high.alias("a"), low.alias("b")).filter("a > b").distinct(), name)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        large = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), name)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
