"""Drift of time windows against a fixed reference period."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.drift import BINS, NO_REFERENCE, bin_of, psi_of_counts, status
from .scoring import served, _write_batch
from .state import state_on_disk

DAY_MS = 86_400_000

# What became of the rows of a day and feature.
CLOSED = "closed"
LATE = "late"
UNDATED = "undated"
# Day of rows without a time, as keys of the state cannot be null; it lies before all times.
_NO_DAY = -(1 << 40)

_PARTIAL = "day long, feature string, bin int, c long, at timestamp"
_OUTCOME = "kind string, day long, feature string, n long, counts array<long>"



def day_window(ts: Column) -> Column:
    """Start of the tumbling one-day window, as ``yyyy-MM-dd``.

    Works on TIMESTAMP and on TIMESTAMP_NTZ; watermarks need the former.
    """
    return F.date_format(F.window(ts.cast("timestamp"), "1 day")["start"], "yyyy-MM-dd")


def window_bin_counts(
    events: DataFrame, edges: DataFrame, ts: str = "ts", late: str = "1 hour"
) -> DataFrame:
    """Streaming counts per day, feature and bin, with a watermark for late rows.

    ``events`` is a stream in long form; ``edges`` the static reference edges. State
    is one counter per (day, feature, bin) still open.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return (
        timed.where(F.col("value").isNotNull())
        .join(edges, "feature")
        .groupBy(
            F.window(ts, "1 day").alias("w"),
            "feature",
            bin_of(F.col("value"), F.col("edges")).alias("bin"),
        )
        .agg(F.count("*").alias("c"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "feature", "bin", "c")
    )


def _partial_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows per day, feature and bin of each Arrow batch, with the latest time among them."""
    for rows in batches:
        if len(rows):
            found = rows.groupby(["day", "feature", "bin"], dropna=False, as_index=False)
            yield found.agg(c=("at", "size"), at=("at", "max"))


class _DayCounts(StatefulProcessor):
    """Bin counts of one open day of one feature, handed on when the watermark closes it.

    The state is one array of ``bins`` numbers. Rows of a day that the watermark has passed
    are not added, whether the day ever had rows or not; they come out as late.
    """

    def __init__(self, bins: int) -> None:
        self.bins = bins

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "counts array<long>")

    def _row(self, kind: str, key: tuple, counts: list[int]) -> pd.DataFrame:
        day, feature = int(key[0]), key[1]
        return pd.DataFrame(
            {"kind": [kind], "day": [day], "feature": [feature], "n": [sum(counts)], "counts": [counts]}
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        day = int(key[0])
        fresh = [0] * self.bins
        for part in rows:
            for b, c in zip(part["bin"], part["c"]):
                fresh[int(b)] += int(c)
        if day == _NO_DAY:
            yield self._row(UNDATED, key, fresh)
            return
        end = (day + 1) * DAY_MS
        if timerValues.getCurrentWatermarkInMs() >= end:
            yield self._row(LATE, key, fresh)
            return
        if self.open.exists():
            fresh = [a + int(b) for a, b in zip(fresh, self.open.get()[0])]
        else:
            self.handle.registerTimer(end)
        self.open.update((fresh,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        counts = [int(c) for c in self.open.get()[0]]
        self.open.clear()
        yield self._row(CLOSED, key, counts)

    def close(self) -> None:
        pass


def day_outcomes(
    events: DataFrame, reference: DataFrame, ts: str = "ts", late: str = "1 hour", bins: int = BINS
) -> DataFrame:
    """A stream of (kind, day, feature, n, psi, status): a day's report once it is closed.

    ``events`` is a stream in long form, ``reference`` the static table of ``reference_bins``.
    Rows without a value or a feature do not count. ``late`` rows, of a day already closed, and ``undated``
    ones, without a time, come out with their number and without a PSI. A feature that the
    reference lacks closes with a status that says so. Watermarks begin at 1970; days before
    are late from the start.

    Events are counted in their own tasks before the shuffle, so a day of any size moves as
    a few rows for each Arrow batch. The time that the watermark follows does not go on with
    the counts: with it Spark would drop late rows before anyone could count them.
    """
    at = F.col(ts).cast("timestamp")
    binned = (
        events.where(F.col("value").isNotNull() & F.col("feature").isNotNull())
        .join(reference.select("feature", "edges"), "feature", "left")
        .select(
            F.coalesce(F.floor(F.unix_millis(at) / DAY_MS), F.lit(_NO_DAY)).alias("day"),
            "feature",
            F.when(F.col("edges").isNull(), 0).otherwise(bin_of(F.col("value"), F.col("edges"))).alias("bin"),
            at.alias("at"),
        )
    )
    counted = binned.mapInPandas(_partial_counts, _PARTIAL).withWatermark("at", late)
    outcomes = (
        counted.select("day", "feature", "bin", "c")
        .groupBy("day", "feature")
        .transformWithStateInPandas(_DayCounts(bins), _OUTCOME, "Append", "EventTime")
    )
    closed = F.col("kind") == CLOSED
    judged = outcomes.join(reference.select("feature", "shares"), "feature", "left").withColumn(
        "psi", F.when(closed, psi_of_counts("shares", "counts"))
    )
    return judged.select(
        "kind",
        F.when(
            F.col("day") != _NO_DAY,
            F.date_format(F.timestamp_millis(F.col("day") * DAY_MS), "yyyy-MM-dd"),
        ).alias("day"),
        "feature",
        "n",
        "psi",
        F.when(closed, F.coalesce(status(F.col("psi")), F.lit(NO_REFERENCE))).alias("status"),
    )


def report_available(outcomes: DataFrame, out: str, checkpoint: str) -> None:
    """Take in what has arrived and stop: ``out``/reports and, aside, ``out``/late.

    A batch that failed runs again under its number and replaces what it had written. Days
    still open stay in the state under ``checkpoint`` and close in a later run.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            closed = F.col("kind") == CLOSED
            _write_batch(rows.where(closed).drop("kind"), f"{out}/reports", number)
            _write_batch(rows.where(~closed).select("kind", "day", "feature", "n"), f"{out}/late", number)
        finally:
            rows.unpersist()

    with state_on_disk(outcomes.sparkSession):
        query = (
            outcomes.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def reports(spark: SparkSession, out: str) -> DataFrame:
    """(day, feature, n, psi, status) of the days closed so far."""
    return served(spark, out, "reports")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """(kind, day, feature, n): rows left out of the reports, added up over all batches."""
    return served(spark, out, "late").groupBy("kind", "day", "feature").agg(F.sum("n").alias("n"))
