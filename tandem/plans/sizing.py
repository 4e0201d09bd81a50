"""Checks of how large a side really is, made before anything is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a pinned table may have. Pinned tables hold summaries (one row per label,
# per feature, per cut), never data rows.
PIN_ROWS = 20_000

# Rows a staged lookup table may have to be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20


def pin_small(df: DataFrame, max_rows: int = PIN_ROWS) -> DataFrame | None:
    """Run a summary once and keep it as a local table, or None if it is too large.

    At most ``max_rows + 1`` rows ever reach the driver. A pinned table is marked
    for broadcast since its size is now known.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """True if a staged table has at most ``max_rows`` rows and ``max_bytes`` as JSON text.

    Rows may hold arrays or texts, so their number alone bounds nothing. The pass is
    distributed; one row with two numbers comes back.
    """
    n, size = df.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    ).first()
    return n <= max_rows and size <= max_bytes
