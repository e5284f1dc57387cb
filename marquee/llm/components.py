"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the links; component: its smallest node.

    Each round hangs the larger neighbours of every node, then its smaller
    ones, onto its smallest neighbour, until only stars are left; the number of
    rounds grows with the logarithm of the longest path. Neighbours are never
    gathered: minima are pre-aggregated and joined back, so a node with very
    many links is split like any skewed join. Each round is a written table.
    Self-links and null ends are ignored; no links give an empty table.
    """
    edges = materialize(links.where(F.col(a) != F.col(b))
                        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state or not now["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u != v").distinct())
