"""Connected components by contraction, for graphs whose edges and nodes only Spark can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkcorpus.llm.common import save


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _clean(edges: DataFrame) -> DataFrame:
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.filter("a <> b").select(a, b).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs to (node, root): one row per node with an edge; nodes share a root if and only if they are
    connected.

    In each round every node moves to its neighbour of the lowest rank, if that is below its own, and the edges follow.
    Ranks are hashes that change with the round, so even a long chain loses a constant share of its nodes per round."""
    left = save(_clean(edges), "edges")
    moves = []
    while not left.isEmpty():
        rank = lambda c, r=len(moves): F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("rank"), F.col(c).alias("node"))
        lowest = _both_ways(left).groupBy("a").agg(F.min(rank("b")).alias("best"))
        up = F.when(F.col("best") < rank("a"), F.col("best.node")).otherwise(F.col("a"))
        move = save(lowest.select(F.col("a").alias("node"), up.alias("up")), "moves")
        moves.append(move)
        first = left.join(move, F.col("a") == F.col("node")).select(F.col("up").alias("a"), "b")
        second = first.join(move, F.col("b") == F.col("node")).select("a", F.col("up").alias("b"))
        left = save(_clean(second), "edges")
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves.pop().select("node", F.col("up").alias("root"))
    while moves:
        later = roots.select(F.col("node").alias("_name"), "root")
        roots = moves.pop().join(later, F.col("up") == F.col("_name"), "left").select("node", F.coalesce("root", "up").alias("root"))
    return save(roots, "roots")
