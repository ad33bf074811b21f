"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.frames import redealt
from stallbook.operators.materialize import materialize


def _smallest_beside(links: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its partners; hot nodes are reduced before the shuffle."""
    return redealt(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "a", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with a link; the component is the smallest node reachable.

    ``edges`` has bigint columns a, b in any direction, with repeats and loops allowed; an end
    that is null is no link. Alternates large-star (larger partners move to the smallest one) and
    small-star (smaller partners do) until each node hangs below its component's smallest. Each
    round is written to the shared folder, which ends its lineage; a hub's rows are joined to one
    row, so adaptive execution can split them.
    """
    spark = edges.sparkSession
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest_beside(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large-star")
        joined = large.join(_smallest_beside(large), "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(joined.select("a", F.col("m").alias("b")))
        edges = materialize(small.distinct(), "small-star")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
