"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempspan.runtime import write_shared


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (columns a and b, long).

    The component is its smallest node. Every round links the neighbours of a node to the
    smallest among them, first those above the node and then those below; stars of any size
    need few rounds. The smallest neighbours come from an aggregation with partial results in
    each task and are written to the shared folder, so that both sides of the two joins of a
    round are plain shuffles: the adaptive planner then splits the neighbours of a node that has very
    many over several tasks.
    """
    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = write_shared(edges.distinct(), "edges")
    before, now = None, _mark(edges)
    while now != before and now[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = write_shared(least, "least")
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct()
        )
        large = write_shared(large, "large")
        below = write_shared(large.groupBy("a").agg(F.min("b").alias("m")), "below")
        small = large.join(below, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(below.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        edges = write_shared(small, "edges")
        before, now = now, _mark(edges)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
