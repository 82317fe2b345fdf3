"""Connected components of a graph given as edges, in rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.arrow import Stage


def _least_neighbours(edges: DataFrame) -> DataFrame:
    """(node, least): the least among each node's neighbours and the node itself."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    return both, both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least of its neighbourhood."""
    both, least = _least_neighbours(edges)
    moved = both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = down.groupBy("node").agg(F.min("other").alias("least"))
    moved = down.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("node", "least")).where("a <> b").distinct()


def components(edges: DataFrame, stage: Stage, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node of its component.

    Alternating large-star and small-star rounds keep the number of edges; after some rounds, about the
    logarithm of the longest path, every node points at its root. Each round's edges are written.
    """
    now = stage.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    mark = None
    for k in range(1, most_rounds + 1):
        now = stage.save(_small_star(_large_star(now)), f"edges-{k}")
        was, mark = mark, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components weren't found in {most_rounds} rounds")
