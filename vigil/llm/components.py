"""Connected components by alternating large and small stars.

Each round is two grouped minima and two joins over the edge list; the number
of rounds grows with the logarithm of the graph, never with its diameter, and
no node's neighbours are ever gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.storage import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u's neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of u, and u itself, to the smallest one.
    Edges come as (larger u, smaller v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc",
                         max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of any comparable type, nulls and self-loops ignored ->
    ``(node, component)`` for every node that has an edge to another node;
    ``component`` is the smallest node of the component.  Repeated and reversed
    edges do not matter; no edges give no rows."""
    now = scratch.keep(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .distinct(), f"{name}-0")
    before = _fingerprint(now)
    for i in range(1, max_rounds + 1):
        now = scratch.keep(_small_star(_large_star(now)), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
