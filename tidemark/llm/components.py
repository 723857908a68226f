"""Connected components of an edge table by alternating large and small stars.

Every round is two joins of the edges with the least neighbour of each node
(pre-aggregated, so a node with a third of all edges is one row on that side
and its edges are split by skew-join handling). Nothing is collected; each
round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u > v): connect every neighbour of u above it (large), or from u down (small), to the least one."""
    both = edges.select("u", "v")
    if large:
        both = both.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join is a stage of its own: a node with a third of all edges is split there
    least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b, any order, repeats allowed).

    ``component`` is the least node of the component. An edge table without
    rows gives no rows; loops and nulls are ignored."""
    now = (edges.where("a is not null and b is not null and a <> b")
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = saved(now, f"{name}-edges")
    mark = _mark(now)
    while True:
        now = saved(_star(_star(now, True), False), f"{name}-stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _mark(edges: DataFrame) -> tuple:
    """Size and an order-free hash of the edge set: equal when a round changes nothing."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
    return (r.n, r.x, r.s)
