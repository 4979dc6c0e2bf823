"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, F.col("a") == F.col("u"))
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest one."""
    low = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("u"), "m")
    moved = (edges.join(low, F.col("b") == F.col("u")).where("a <> m")
             .select(F.col("m").alias("a"), F.col("a").alias("b")))
    return moved.unionAll(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is
    named by its smallest node.

    Each round is one large-star and one small-star step, written to the shared
    folder; the loop ends when a round changes nothing (every node then hangs
    on its component's smallest node).  Self-loops and repeated edges are
    allowed, null ends are ignored.  The hot node of a big star is only ever
    aggregated (partial minima) or joined with one small row.
    """
    edges = stage(edges.where("a is not null and b is not null and a <> b")
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        edges = stage(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()))
