"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from feedloom.llm.common import join_shuffled
from feedloom.operators.stage import staged

#: They have up to twice as many nodes: as hash tables 8 MB of whole numbers, 26 MB of pairs of them.
SMALL_EDGES = 1 << 16


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, from links (a, b) with a < b; root is the smallest node reachable.

    Nodes may be of any type that orders. Up to ``SMALL_EDGES`` edges, counted while they are written, the smallest
    neighbours are broadcast. Beyond, they are written before they are joined back, so the join is one of two plain tables
    and a node with very many links can be split.
    """

    def stage_edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        mark = F.xxhash64("a", "b")
        table = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"), F.max(mark).alias("m")), "star-edges")
        return table, (seen.get["n"], seen.get["x"], seen.get["m"])

    def star(edges: DataFrame, both: bool, small: bool) -> DataFrame:
        """Ties the larger neighbours (both) or all smaller ones to the smallest neighbour of a node."""
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        pairs = down.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) if both else down
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if small:
            tied = pairs.join(F.broadcast(least), "u")
        else:
            least = staged(least, "star-least")
            tied = join_shuffled(pairs, least, "u")
        if both:
            tied = tied.filter(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            tied = tied.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return tied.filter(F.col("a") < F.col("b")).distinct()

    edges, mark = stage_edges(links)
    while mark[0]:
        small = mark[0] <= SMALL_EDGES
        edges, now = stage_edges(star(star(edges, True, small), False, small))
        if now == mark:
            break
        mark = now
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
