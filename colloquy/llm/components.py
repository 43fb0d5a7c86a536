"""Connected components of a graph by alternating large-star and small-star rounds.

Both stars only ever point nodes at the smallest of their neighbours, found by
a pre-aggregated minimum. The minimums are written before edges meet them: then
both sides of that join are plain shuffles, which Spark may split where a node
has very many edges, or the minimums are small enough to be sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store


def _round(edges: DataFrame, store: Store) -> DataFrame:
    """One large star and one small star; frees edges and what it makes on the way."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = store.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    large = store.save(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    store.free(edges, least)
    least = store.save(large.groupBy("u").agg(F.min("v").alias("m")))
    moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = store.save(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    store.free(large, least)
    return small


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, store: Store) -> DataFrame:
    """Labels (node, root) of the nodes that have a smaller one in their component.

    edges: two long columns a and b, in any direction, loops and repeats
    allowed. Roots themselves and isolated nodes have no row.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = store.save(pairs)
    seen = _state(now)
    while seen[0]:
        now = _round(now, store)
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
