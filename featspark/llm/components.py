"""Connected components by alternating large-star and small-star rounds.

Nodes are longs; the component label is the least node.  Every round is an
aggregate and an equi-join over the edges, written to the shared folder; no
node's edges meet in one task (least neighbours are partial aggregates, joins
on a centre with very many edges are split by adaptive execution).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import Scratch


def _least(e: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours v."""
    m = e.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    return e.join(m, e["u"] == m["_u"]).select("u", "v", F.least("u", "m").alias("m"))


def large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _least(down)
    out = m.select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` are (u, v)."""
    e = scratch.write("edges0", edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for i in range(1, rounds + 1):
        new = scratch.write(f"edges{i}", small_star(large_star(e)))
        scratch.drop(f"edges{i - 1}")
        e = new
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select("v", "v").distinct())
