"""Connected components of an edge table, as rounds of DataFrame aggregates and joins.

Alternating stars: the large star links every larger neighbour of a node to the smallest node next to it, the small
star links a node and its smaller neighbours to the smallest of them. Both keep components whole; when neither changes
an edge, every node points at the smallest node of its component. Each round combines minima map-side, so a hub
with a third of all edges reaches the reducers as a few rows, and joins back over a shuffle that AQE can split.
Rounds are written to the shared folder, so lost executors only repeat the current one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MAX_ROUNDS = 60


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest v of its u, or u itself if that is smaller."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return pairs.join(low, pairs.u == low.n).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    starred = _with_min(edges)
    links = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(starred.select("u", F.col("m").alias("v")))
    return links.filter("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): every node of an edge with the smallest node it reaches. Nodes can be of any ordered type.

    Null ends and loops are left out; nodes without an edge don't appear (the caller treats them as their own component).
    """
    clean = (edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND x <> y")
             .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    now = materialize(clean, name)
    state = _state(now)
    if state[0]:
        for _ in range(MAX_ROUNDS):
            now = materialize(_small_star(_large_star(now)), name)
            before, state = state, _state(now)
            if state == before:
                break
        else:
            raise RuntimeError(f"{name}: no fixed point after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
