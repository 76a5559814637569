"""Connected components of a large edge list, by alternating star contractions on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored


def _signature(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of `edges` (a, b: bigint, a != b, no nulls).

    Each round links every larger neighbour, then every smaller one, to the smallest of the neighbourhood, so a path
    halves and a star stays. Neighbourhood minima are map-side combined and joined back: a hub of any degree
    is never held in one task. Ends when a round changes nothing.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(now)
    while before["n"]:
        # Large star: larger neighbours of u go to the least of u and its neighbours.
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(
            low.select("a", F.col("m").alias("b"))).distinct()
        now = stored(small, "edges")
        after = _signature(now)
        if after == before:
            break
        before = after
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
