"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import drop_staged, staged


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, component)``; component is the smallest node reachable.

    Every step is a grouped minimum joined back to the edges, so a star's centre with
    many neighbours is combined before the shuffle and its join side can be split.
    Each step's edges are written to the shared folder; the loop ends when a pair of
    steps changes nothing. ``rows``: how many edges there are at most, if that is known. Nodes without an edge to another node are not returned.
    """
    now = staged(edges.select("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", rows)
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        # no more edges than before: few files for few of them
        last, now = now, staged(small, "edges", rows=mark[0])
        drop_staged(last)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
