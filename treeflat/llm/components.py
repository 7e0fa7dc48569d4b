"""Connected components of a table of links, by alternating large and small stars.

Every step is a grouped minimum (partial aggregates) and a join with a table that was written before, so a node with very
many links is split like any skewed join.  Steps are written to the shared folder: nothing depends on an executor's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treeflat.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour of a node (large star: those above it; small star: those below it, and itself) to the smallest."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components-least")
    linked = both.join(least, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node that can be reached.  Loops and repeats do no harm."""
    edges = staged(links.select("a", "b").filter("a != b").distinct(), "components-edges")
    before = None
    while True:
        edges = staged(_star(staged(_star(edges, True), "components-large"), False), "components-small")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
