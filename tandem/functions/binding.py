"""Evaluating an expression once where its value is used several times.

Filters pushed through a projection and lambdas over arrays both repeat the
expressions they refer to. ``let`` binds a value inside one expression, ``computed``
adds columns that later filters and projections read but never re-derive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add columns behind a one-row generator, which the optimizer does not inline."""
    row = F.struct(*[c.alias(name) for name, c in cols.items()])
    kept = [c for c in df.columns if c not in cols]
    return df.select(*kept, F.inline(F.array(row)))
