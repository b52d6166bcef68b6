"""Connected components of an edge table by alternating star contractions.

Each round links every node to the least node of its neighbourhood, first upwards (large star), then
downwards (small star), until the edges stand still; the rounds grow with the logarithm of the longest
path.  Least neighbours are written as a table before they are joined, so that both sides of the join
are plain shuffles and Spark can split a hub node's rows over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm._store import materialize, release


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """New edges ``(a, b)``, a > b, from directed ``pairs(u, v)``."""
    least = materialize(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return materialize(out.filter("a <> b").distinct(), "edges")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a long, b long)``; root is its component's least node."""
    spark = edges.sparkSession
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        edges = _star(both, True)
        edges = _star(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), False)
        before, state = state, _state(edges)
        release(spark)
        if before == state:
            break
    else:
        raise RuntimeError("the components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select("b", "b").distinct())
