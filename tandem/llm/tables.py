"""Small shared steps: tables of the data folder, staged results, broadcast arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage_table
from ..sources.tables import table

__all__ = ["fold_ascii", "per_batch", "row_key", "sha256_of", "stage_table", "table"]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def row_key(doc_id: Column, text: Column) -> Column:
    """A key by which repeated rows are alike and other rows are not."""
    return F.xxhash64(doc_id, text)


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def per_batch(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            yield fn(batch)

    return run


def only(df: DataFrame, *columns: Column) -> DataFrame:
    """The named inputs and nothing else, so that no other column can clash."""
    return df.select(*columns)
