"""Connected components of an edge table by alternating stars, all in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smeltery.session import stage


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("x", "y")), F.lit(0))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges(x, y)``; the root is the smallest node reachable.

    Each round links every larger neighbour of a node to the smallest one around it (large star),
    then every smaller neighbour likewise (small star). Only minima are gathered for a node, as
    partial aggregates, so a node with very many links is no single task's work. Rounds grow with
    the logarithm of the longest path. What a round makes is written to the shared folder.
    """
    edges = stage(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = both.join(least, "x").filter(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(F.explode(F.array(
            F.struct(F.col("x"), F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
        edges = stage(small.select("e.x", "e.y").filter("x <> y").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).union(roots)
