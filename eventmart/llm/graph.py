"""Connected components of an edge list, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.session import durable, release


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of `edges` (a long, b long) is connected to.

    Alternates the large-star and small-star steps until every node hangs on its root. Each
    round is two aggregates and two joins over the edges and leaves a durable copy; a hub's
    edges are combined before the shuffle and split by skew joins, never gathered in one row.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large, "edges")
        release(now)
        least = _least(large)
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = durable(hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        release(large)
