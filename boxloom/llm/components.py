"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` edges of orderable ids -> ``(node, root)`` with the smallest id of its component.

    Nodes without an edge are not listed, and a root is not listed for itself. Each round is a few
    shuffles of the edges, written to the shared folder; rounds grow with the logarithm of the
    longest chain. No neighbour list is ever gathered.
    """
    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()

    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = mark(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = written(_small_star(_large_star(edges)))
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
