"""Which ranges of a table changed between two versions: a tree of fingerprints.

Rows are put into ranges of ``width`` keys, each range gets the fingerprint of its rows, and
each node above that of its ``FAN`` children; one node stands over all. Equal tops prove equal
tables. Unequal ones are followed downwards, so a comparison reads the nodes on the way to
the ranges that differ, and no rows. All fingerprints are sums that combine before the
shuffle (``registry.fingerprint``): neither a full range nor a key of many rows gathers.

A tree is a table (level, node, n_rows, hash) with ranges at level 0; ``n_rows`` counts rows
of the table at every level. Rows without a key form a range of their own, NULL. An empty
table has an empty tree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import fits_broadcast
from ..plans.staging import stage_table
from .registry import fingerprint

# Keys of a range, children of a node, levels below the top.
WIDTH, FAN, LEVELS = 4096, 64, 4


def range_of(key: Column, width: int = WIDTH) -> Column:
    """Number of the range that an integer key lies in, downwards for negative keys."""
    if width & (width - 1):
        raise ValueError("the width must be a power of two")
    return F.shiftright(key.cast("long"), width.bit_length() - 1)


def _parent(level: int) -> Column:
    """Parent of a node at ``level``; the top stands over all."""
    return F.lit(0).cast("long") if level + 1 == LEVELS else F.shiftright("node", FAN.bit_length() - 1)


def _ranges(df: DataFrame, key: str, columns: list[str], width: int) -> DataFrame:
    rows = df.select(range_of(F.col(key), width).alias("node"), F.col(key).alias("_key"), *columns)
    return fingerprint(rows, "_key", columns, ["node"]).select(
        "node", "n_rows", F.col("dataset_hash").alias("hash")
    )


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes over the nodes of ``level``."""
    up = nodes.withColumn("parent", _parent(level))
    prints = fingerprint(up, "node", ["n_rows", "hash"], ["parent"]).select("parent", "dataset_hash")
    rows = up.groupBy("parent").agg(F.sum("n_rows").alias("n"))
    both = prints.alias("p").join(rows.alias("r"), F.col("p.parent").eqNullSafe(F.col("r.parent")))
    return both.select(F.col("p.parent").alias("node"), F.col("n").alias("n_rows"), F.col("dataset_hash").alias("hash"))


def _stack(levels: list[DataFrame]) -> DataFrame:
    named = [d.select(F.lit(i).alias("level"), "node", "n_rows", "hash") for i, d in enumerate(levels)]
    return reduce(DataFrame.unionByName, named)


def _level(tree: DataFrame, level: int) -> DataFrame:
    return tree.where(F.col("level") == level).select("node", "n_rows", "hash")


def build(df: DataFrame, key: str, columns: list[str], width: int = WIDTH) -> DataFrame:
    """The tree of a table by an integer ``key``, over the values of ``columns``."""
    levels = [stage_table(_ranges(df, key, columns, width), "tree_ranges")]
    for level in range(LEVELS):
        levels.append(stage_table(_above(levels[-1], level), "tree_nodes"))
    return _stack(levels)


def _kept(df: DataFrame, node: Column, wanted: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose node is (``semi``) or is not (``anti``) in ``wanted`` (node)."""
    right = wanted.select(F.col("node").alias("_wanted"))
    right = F.broadcast(right) if fits_broadcast(right) else right
    return df.join(right, node.eqNullSafe(F.col("_wanted")), f"left_{how}")


def update(
    tree: DataFrame, df: DataFrame, key: str, columns: list[str], changed: DataFrame, width: int = WIDTH
) -> DataFrame:
    """The tree of the new version ``df``, where only the ranges ``changed`` (node) may differ
    from the old one's. Only their rows are hashed, and only nodes above them made anew."""
    touched = stage_table(changed.select("node").distinct(), "tree_touched")
    rows = _kept(df, range_of(F.col(key), width), touched, "semi")
    fresh = _ranges(rows, key, columns, width)
    levels = []
    for level in range(LEVELS + 1):
        old = _kept(_level(tree, level), F.col("node"), touched, "anti")
        levels.append(stage_table(old.unionByName(fresh), "tree_level"))
        if level < LEVELS:
            touched = stage_table(touched.select(_parent(level).alias("node")).distinct(), "tree_touched")
            fresh = _above(_kept(levels[-1], _parent(level), touched, "semi"), level)
    return _stack(levels)


def changed_ranges(before: DataFrame, after: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, first_key, last_key, n_before, n_after) of the ranges whose rows differ between
    two trees of equal width; ``n_before`` or ``n_after`` is zero where a version has none."""
    found = None
    for level in range(LEVELS, -1, -1):
        sides = []
        for tree in (before, after):
            nodes = _level(tree, level)
            sides.append(nodes if found is None else _kept(nodes, _parent(level), found, "semi"))
        a, b = sides[0].alias("a"), sides[1].alias("b")
        both = a.join(b, F.col("a.node").eqNullSafe(F.col("b.node")), "full")
        differ = both.where(~F.col("a.hash").eqNullSafe(F.col("b.hash"))).select(
            F.coalesce("a.node", "b.node").alias("node"),
            F.coalesce("a.n_rows", F.lit(0)).alias("n_before"), F.coalesce("b.n_rows", F.lit(0)).alias("n_after"),
        )
        found = stage_table(differ, "tree_differ")
    first = F.col("node") * width
    return found.select("node", first.alias("first_key"), (first + width - 1).alias("last_key"), "n_before", "n_after")


def changed_keys(
    before: DataFrame, after: DataFrame, key: str, columns: list[str], ranges: DataFrame, width: int = WIDTH
) -> DataFrame:
    """(key, change) of the keys whose rows differ, ``added``, ``removed`` or ``changed``; only
    rows of the ``ranges`` are compared. Rows that share a key are compared as one."""
    ranges = stage_table(ranges.select("node"), "tree_compared")
    a, b = [
        fingerprint(_kept(df, range_of(F.col(key), width), ranges, "semi").select(key, F.col(key).alias("_key"), *columns),
                    "_key", columns, [key]).alias(name)
        for df, name in ((before, "a"), (after, "b"))
    ]
    both = a.join(b, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full")
    change = F.when(F.col("a.dataset_hash").isNull(), "added").when(F.col("b.dataset_hash").isNull(), "removed")
    return both.where(~F.col("a.dataset_hash").eqNullSafe(F.col("b.dataset_hash"))).select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.coalesce(change, F.lit("changed")).alias("change")
    )
