"""Connected components of a large graph, by alternating stars.

Each round is two groupings with partial aggregation; no component is ever gathered,
and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage_table

MAX_ROUNDS = 100


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the least of them and the node itself.

    A large star links the neighbours above a node, a small one those below it.
    ``pairs`` has (a, b) with a > b.
    """
    near = pairs
    if large:
        near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    linked = near.where("b > a" if large else "b < a").join(least, "a")
    out = linked.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("low").alias("b")))
    return out.where("a > b").distinct()


def _digest(pairs: DataFrame):
    return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node that is in
    ``pairs`` (a, b) and is not the root itself. Pairs may repeat and go either way."""
    pairs = pairs.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b").distinct()
    pairs = stage_table(pairs, "links")
    last = _digest(pairs)
    for _ in range(MAX_ROUNDS):
        if not last[0]:
            break
        pairs = stage_table(_star(_star(pairs, True), False), "stars")
        now = _digest(pairs)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components are not stable after {MAX_ROUNDS} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
