"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``: the smallest id reachable.

    Each round links all larger neighbours of a node, then all smaller ones, to the smallest
    neighbour, by aggregates and joins only (no neighbour list is gathered); rounds grow with
    the logarithm of the longest path. Nulls and loops are ignored.
    """
    e = scratch(edges.where((F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(e.select("b", "b").distinct())
        mark = now
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(low, "a")
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        e = scratch(small.where(F.col("a") != F.col("b")).distinct(), "edges")


def roots(parents: DataFrame) -> DataFrame:
    """``(id, component)`` of a forest ``parents(a, b)`` with one smaller parent ``b`` for each ``a``: pointers are doubled until all end at a root."""
    up = scratch(parents.select(F.col("a").alias("id"), F.col("b").alias("component")), "roots")
    while True:
        above = up.select(F.col("id").alias("component"), F.col("component").alias("above"))
        up = scratch(up.join(above, "component", "left").select("id", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved")), "roots")
        moved = up.where("moved").limit(1).count()
        up = up.select("id", "component")
        if not moved:
            return up.unionAll(up.select("component", "component").distinct())
