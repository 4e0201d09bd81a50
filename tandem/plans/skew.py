"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType

from .sizing import BROADCAST_ROWS, fits_broadcast

# A key is heavy when it owns at least one share of all rows. There are as many shares as
# shuffle partitions, and at least so many; there can be no more heavy keys than shares.
LEAST_SHARES = 256
# A heavy key is split into at least so many parts, and into one for every share it owns.
LEAST_SALTS = 32
# Keys of a table too large to be broadcast that are broadcast all the same: the most frequent.
FREQUENT_KEYS = 500_000


def shares(spark: SparkSession) -> int:
    return max(LEAST_SHARES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def heavy_keys(counts: DataFrame, key: str, n: str) -> dict:
    """Keys of ``counts(key, n)`` that own a share of the rows or more, each with its
    number of salts. No more than one key a share reaches the driver."""
    parts = shares(counts.sparkSession)
    total = counts.agg(F.sum(n)).first()[0] or 0
    rows = counts.where((F.col(n) > 0) & (F.col(n) * parts >= total)).select(key, n).limit(parts).collect()
    return {k: max(LEAST_SALTS, -(-c * parts // total)) for k, c in rows if k is not None}


def _salts(df: DataFrame, key: str, heavy: dict) -> Column:
    """Number of salts of a row's key: that of a heavy key, else 1."""
    pairs = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    typed = pairs.cast(MapType(df.schema[key].dataType, LongType()))
    return F.coalesce(F.element_at(typed, F.col(key)), F.lit(1).cast("bigint"))


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    heavy: dict,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """Equi-join where the rows of heavy keys are spread over their salts.

    ``spread`` is any well distributed column of ``rows``; matching ``table`` rows of
    heavy keys are repeated once per salt. Result equals the plain join.
    """
    if not heavy:
        return rows.join(table, key, how)
    salt = F.pmod(F.xxhash64(spread), _salts(rows, key, heavy))
    left = rows.withColumn("_salt", salt)
    copies = F.sequence(F.lit(0).cast("bigint"), _salts(table, key, heavy) - 1)
    right = table.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: Column,
    counts: DataFrame,
    n: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Attach ``table`` (one row per key, staged) to ``rows``.

    A table within ``max_rows`` is broadcast; a larger one is joined by a salted
    shuffle whose heavy keys come from ``counts(key, n)``.
    """
    if fits_broadcast(table, max_rows):
        return rows.join(F.broadcast(table), key, how)
    return salted_join(rows, table, key, heavy_keys(counts, key, n), spread, how)


def frequent_lookup(rows: DataFrame, table: DataFrame, key: str, spread: Column, n: str) -> DataFrame:
    """Attach ``table`` (one row per key, staged, with the number ``n`` of its rows) to ``rows``.

    Of a table too large to be broadcast, the most frequent keys are, so that only rows of
    rare keys move. ``rows`` are made once for either kind.
    """
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), key)
    share = FREQUENT_KEYS / max(table.count(), 1)
    least = -1 if share >= 1 else table.agg(F.percentile_approx(n, 1 - share, 10_000)).first()[0]
    common = table.where(F.col(n) > least)
    if not fits_broadcast(common):
        return salted_join(rows, table, key, heavy_keys(table, key, n), spread)
    found = rows.join(F.broadcast(common), key)
    # No rare key is heavy: half a million others are at least as frequent.
    rest = rows.join(F.broadcast(common.select(key)), key, "left_anti").join(table.where(F.col(n) <= least), key)
    return found.unionByName(rest)
