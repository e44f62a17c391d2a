"""Connected components of a table of links, by alternating star contraction.

Each round joins every node to the smallest node around it: the large-star step
hangs larger neighbours on the smallest one, the small-star step does so with the
smaller neighbours and the node itself.  Minima are taken by partial
aggregates, so a hub with most of the links is no single task's work; the table
of links is written each round, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u > v): neighbours hang on the smallest neighbour."""
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = sides.join(least, "u")
    moved = hung.where("v > u" if large else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; ``links`` has (a, b), root is the smallest node."""
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links"
    )
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    seen = mark(edges)
    while seen[0]:
        edges = written(_star(_star(edges, True), False), "stars")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
