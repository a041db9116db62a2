"""Connected components by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import stage

#: Fixed seed of an order-free digest of an edge list.
_DIGEST = "sum(cast(xxhash64(u, v) as decimal(38, 0)))"


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in (u, v) edges; the component is its least id.

    A large star ties all larger neighbours of a node to the least id around it, a small star does
    the same for the smaller ones. Both keep components whole, and what is left in the end is one
    star per component. Each step joins a node's least neighbour, one row, to its edges, so a node
    with many edges is split like any skewed join; its minimum is combined before the shuffle.
    """
    now = stage(_canonical(edges.select("u", "v")), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.expr(_DIGEST)).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = stage(_small_star(stage(_large_star(now), "edges")), "edges")
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _canonical(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _canonical(tied.unionByName(least.select("u", F.col("m").alias("v"))))
