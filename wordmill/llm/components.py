"""Connected components of an edge table by alternating star contractions.

Each round is two aggregations of a minimum and two equi-joins, so no task holds the
neighbours of a node and nothing is collected; the number of rounds grows with the
logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``: the smallest node it
    can reach. Rows with a null end, loops and repeated edges are harmless."""
    now = cut_lineage(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v").distinct())
    before = _state(now)
    while before[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)


def hooked(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """``(node, component)`` in a few steps: every node takes its smallest neighbour, then
    ``jumps`` times the label of its label. Nodes with one label are in one component, but
    a component may still have several labels."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("component")))
    for _ in range(jumps):
        up = label.select(F.col("node").alias("component"), F.col("component").alias("next"))
        label = label.join(up, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return cut_lineage(label)
