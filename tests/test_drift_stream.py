"""Days of a stream of events, reported once each when the watermark closes them."""

import random

import pytest
from pyspark.sql import functions as F

import tandem.operators.drift as dr
from tandem.streaming import drift as sd

SCHEMA = "ts timestamp, feature string, value double"


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, "ts string, feature string, value double")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def reference(spark):
    rng = random.Random(3)
    rows = [("2023-12-01 00:00:00", f, rng.gauss(0, 1)) for f in "ab" for _ in range(500)]
    return rows_of(spark, rows).cache()


@pytest.fixture(scope="module")
def bins(reference):
    return dr.reference_bins(reference)


class Feed:
    """An inbox that files arrive in, each followed by a run to the end of what is there."""

    def __init__(self, spark, folder, bins):
        self.spark, self.bins = spark, bins
        self.inbox, self.out, self.state = (str(folder / n) for n in ("in", "out", "state"))

    def arrive(self, rows):
        rows_of(self.spark, rows).write.mode("append").parquet(self.inbox)
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.inbox)
        sd.report_available(sd.day_outcomes(stream, self.bins), self.out, self.state)

    def reports(self):
        return {(r.day, r.feature): r for r in sd.reports(self.spark, self.out).collect()}

    def late(self):
        return {(r.kind, r.day, r.feature): r.n for r in sd.late_rows(self.spark, self.out).collect()}


def day(d, n, feature, shift, seed):
    rng = random.Random(seed)
    return [
        (f"2024-01-{d:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", feature, rng.gauss(shift, 1))
        for _ in range(n)
    ]


def test_closed_days_equal_the_batch_report_across_restarts(spark, tmp_path, reference, bins):
    feed = Feed(spark, tmp_path, bins)
    first = day(1, 300, "a", 0, 1) + day(1, 200, "b", 2, 2) + day(2, 100, "a", 0, 4)
    feed.arrive(first)
    # The watermark of the first file, at most 23:00 of the second day, closes the first day only.
    assert set(feed.reports()) == {("2024-01-01", "a"), ("2024-01-01", "b")}
    second = day(2, 150, "a", 0.5, 5) + day(2, 50, "b", 0, 6)
    feed.arrive(second + [("2024-01-03 02:00:00", "a", 0.0)])
    got = feed.reports()
    every = rows_of(spark, first + second).withColumn("day", sd.day_window(F.col("ts")))
    want = {(r.day, r.feature): r for r in dr.drift_report(reference, every, ["day"]).collect()}
    assert set(got) == set(want) and len(got) == 4
    for key, r in want.items():
        assert got[key].psi == pytest.approx(r.psi, abs=1e-12) and got[key].status == r.status
    assert [got["2024-01-02", f].n for f in "ab"] == [250, 50]
    assert feed.late() == {}


def test_late_and_undated_rows_are_counted_aside(spark, tmp_path, bins):
    feed = Feed(spark, tmp_path, bins)
    feed.arrive(day(1, 40, "a", 0, 1) + [("2024-01-03 02:00:00", "a", 1.0), (None, "a", 1.0)])
    before = feed.reports()
    assert before["2024-01-01", "a"].n == 40
    late = [("2024-01-01 05:00:00", "a", 9.0)] * 3 + [("2024-01-01 05:00:00", "a", None)]
    # A feature that had no row on the closed day is late as well; the open day takes its row.
    feed.arrive(late + [("2024-01-01 06:00:00", "b", 1.0), ("2024-01-03 04:00:00", "a", 1.0)])
    # A file of nothing but late rows is counted too.
    feed.arrive([("2024-01-01 07:00:00", "a", 2.0)])
    assert feed.reports() == before
    assert feed.late() == {
        ("undated", None, "a"): 1, ("late", "2024-01-01", "a"): 4, ("late", "2024-01-01", "b"): 1,
    }
    feed.arrive([("2024-01-05 00:00:00", "a", 0.0)])
    assert feed.reports()["2024-01-03", "a"].n == 2


def test_features_without_reference_close_with_a_status(spark, tmp_path, bins):
    feed = Feed(spark, tmp_path, bins)
    feed.arrive(day(1, 5, "new", 0, 1) + [("2024-01-04 00:00:00", "a", float("nan"))])
    (only,) = feed.reports().values()
    assert (only.feature, only.n, only.psi, only.status) == ("new", 5, None, dr.NO_REFERENCE)


def test_the_shuffle_moves_counts_not_events():
    import pandas as pd

    at = pd.Timestamp("2024-01-01 10:00:00")
    rows = pd.DataFrame({"day": 19723, "feature": "f", "bin": [0, 1] * 5000, "at": at})
    (out,) = sd._partial_counts([rows, rows.iloc[:0]])
    assert list(out["c"]) == [5000, 5000] and list(out["at"]) == [at, at]
