"""Connected components by alternating large-star and small-star.

Every step is an aggregate and a join on edge tables; only the number of edges and
a checksum reach the driver. Minima are pre-aggregated per task, written, and joined
back as plain tables, so the star of a hub is split by the skew join, never
gathered in one task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import Scratch


def _least(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Smallest neighbour (or the node itself) per ``u``."""
    return scratch.save(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), name)


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each node hands its larger neighbours to its smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, scratch, f"{name}-least")
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = _least(edges, scratch, f"{name}-least")
    joined = edges.join(least, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); component is the
    smallest node reachable. Ends when a round changes no edge."""
    start = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    cur = scratch.save(start, f"{name}-0")
    mark = _mark(cur)
    k = 0
    while mark[0]:
        k += 1
        large = scratch.save(_large_star(cur, scratch, f"{name}-{k}l"), f"{name}-{k}l")
        nxt = scratch.save(_small_star(large, scratch, f"{name}-{k}s"), f"{name}-{k}")
        new = _mark(nxt)
        scratch.drop(f"{name}-{k - 1}", f"{name}-{k}l", f"{name}-{k}l-least", f"{name}-{k}s-least")
        cur = nxt
        if new == mark:
            break
        mark = new
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]
