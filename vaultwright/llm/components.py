"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import written


def _toward(edges: DataFrame) -> DataFrame:
    """Each edge at both ends, with the smallest node next to that end or the end itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("least"))
    return both.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of its neighbourhood."""
    return _toward(edges).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()


def component_roots(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    ``edges`` has columns a and b of one type; order, repeats and loops do not matter.
    Large and small stars alternate until no edge changes, about log(nodes) rounds. Each
    round is written to the shared folder. Neighbours of a node are only ever reduced to
    their smallest, never gathered, so a node may have any number of them.
    """
    state = written(edges.filter("a != b").select("a", "b").distinct(), "components")
    mark = None
    for _ in range(most_rounds):
        state = written(_small_star(_large_star(state)), "components")
        row = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            stars = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
        mark = tuple(row)
    raise RuntimeError(f"components still change after {most_rounds} rounds")
