"""The store of days against numpy and the report that reads all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import days as dy
from tandem.operators import drift as dr

DAYS = [f"2024-03-{d:02d}" for d in range(1, 8)]


def sample(day: int) -> list[tuple]:
    """Skewed, constant, few-valued and drifting features of a day."""
    rng = np.random.default_rng(day)
    n = 400 + 300 * day
    return (
        [("skewed", float(x)) for x in rng.lognormal(0, 2, n)]
        + [("constant", 4.0)] * n
        + [("few", float(x)) for x in rng.integers(0, 3, n)]
        + [("moving", float(x)) for x in rng.normal(day, 1, n)]
        + ([("rare", -math.inf), ("rare", 2.5), ("rare", math.inf)] if day == 2 else [])
        + [("few", None), ("few", math.nan), (None, 1.0)]
    )


def long(spark, days):
    rows = [(DAYS[d], f, v) for d in days for f, v in sample(d)] + [(None, "few", 9.0)]
    return spark.createDataFrame(rows, "day string, feature string, value double")


def expected(days, feature):
    kept = [v for d in days for f, v in sample(d) if f == feature and v is not None and not math.isnan(v)]
    return len(kept), np.quantile(kept, [i / 10 for i in range(1, 10)])


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = dy.DayStore(spark, str(tmp_path_factory.mktemp("days")))
    out.add(long(spark, range(4)))
    out.add(long(spark, range(3, 7)))
    return out


@pytest.mark.parametrize("days", [range(7), range(2, 5), range(6, 7)])
def test_edges_of_any_days_are_exact(store, days):
    got = {r.feature: r for r in store.edges(DAYS[days[0]], DAYS[days[-1]]).collect()}
    for name in ("skewed", "constant", "few", "moving"):
        n, want = expected(days, name)
        assert got[name].n == n
        assert got[name].edges == pytest.approx(want, rel=1e-12)
    assert ("rare" in got) == (2 in days)


def test_crowded_brackets_are_narrowed(store, monkeypatch):
    monkeypatch.setattr(dy, "WINDOW_VALUES", 20)
    monkeypatch.setattr(dy, "AROUND", (0.3,))
    got = {r.feature: r.edges for r in store.edges().collect()}
    for name in ("skewed", "constant", "few", "moving"):
        assert got[name] == pytest.approx(expected(range(7), name)[1], rel=1e-12)


def test_scans_without_ranges_give_the_same(store, monkeypatch):
    points = store.spark.createDataFrame([("skewed", 1.0), ("few", 1.0), ("few", 9.0)], "feature string, x double")
    order = lambda df: sorted(map(tuple, df.collect()))
    first = order(store.counts_below(points, by_day=True))
    monkeypatch.setattr(dy, "SCAN_RANGES", 0)
    monkeypatch.setattr(dy, "fits_broadcast", lambda *a: False)
    assert order(store.counts_below(points, by_day=True)) == first
    want = [(DAYS[d], f, x, sum(v < x for g, v in sample(d) if g == f and v is not None))
            for d in range(7) for f, x in (("few", 1.0), ("few", 9.0), ("skewed", 1.0))]
    assert first == want


@pytest.mark.parametrize("by_day", [False, True])
def test_report_equals_the_report_of_all_rows(spark, store, by_day):
    got = store.report((None, DAYS[1]), (DAYS[2], None), by_day)
    good = lambda days: long(spark, days).where("day IS NOT NULL AND feature IS NOT NULL AND NOT isnan(value)")
    want = dr.drift_report(good(range(2)), good(range(2, 7)), ["day"] if by_day else [])
    rows = lambda df: {(r.asDict().get("day"), r.feature): (r.psi, r.status) for r in df.collect()}
    got, want = rows(got), rows(want)
    assert got.keys() == want.keys()
    for key, (psi, status) in want.items():
        assert got[key][1] == status
        assert got[key][0] == pytest.approx(psi, abs=1e-9) if psi is not None else got[key][0] is None
    assert any(status == dr.NO_REFERENCE for _, status in got.values())


def test_a_day_added_again_replaces_itself(spark, tmp_path):
    store = dy.DayStore(spark, str(tmp_path / "s"))
    assert store.edges().count() == 0
    one = lambda day, v: spark.createDataFrame([(day, "f", v)] * 3, "day string, feature string, value double")
    store.add(one("2024-01-01", 1.0))
    store.add(one("2024-01-02", 2.0))
    store.add(one("2024-01-01", 7.0))
    assert store.edges("2024-01-01", "2024-01-01").first().edges == [7.0] * 9
    assert {(r.day, r.v, r.n) for r in store.table("values").collect()} == {("2024-01-01", 7.0, 3), ("2024-01-02", 2.0, 3)}


def test_a_failed_addition_changes_nothing(spark, tmp_path, monkeypatch):
    store = dy.DayStore(spark, str(tmp_path / "s"))
    rows = lambda day, v: spark.createDataFrame([(day, "f", v)] * 2, "day string, feature string, value double")
    store.add(rows("2024-01-01", 1.0))
    write = dy.DayStore._write

    def fails(self, name, *rest):
        if name == "sketches":
            raise OSError("lost")
        write(self, name, *rest)

    with monkeypatch.context() as m:
        m.setattr(dy.DayStore, "_write", fails)
        for day in ("2024-01-01", "2024-01-02"):
            with pytest.raises(OSError):
                store.add(rows(day, 5.0))
    points = spark.createDataFrame([("f", 9.0)], "feature string, x double")
    assert [r.below for r in store.counts_below(points).collect()] == [2]
    store.add(rows("2024-01-01", 5.0))
    assert [tuple(r) for r in store.table("values").select("v", "n").collect()] == [(5.0, 2)]


def test_closed_days_are_not_read_again(store):
    """A range of days reads its own partitions, and values only near the points."""
    near = store._between(store.spark.createDataFrame([("few", 1.0, 1.0)], "feature string, a double, z double"), DAYS[1], DAYS[2])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters: [Or" in plan or "GreaterThanOrEqual(v,1.0)" in plan
    assert near.where(F.col("feature") != "few").count() == 0
    assert "dynamicpruning" in plan
    assert {r.day for r in near.select("day").distinct().collect()} == {DAYS[1], DAYS[2]}


def test_pages_are_found_by_halving(spark):
    cuts = [[], [2.0], [-math.inf, 0.0, 1.5, math.inf], [float(i) for i in range(dy.PAGES - 1)]]
    rows = [(c, v) for c in cuts for v in (-math.inf, -1.0, 0.0, 1.5, 2.0, 126.5, 254.0, 300.0, math.inf)]
    df = dy._with_page(spark.createDataFrame(rows, "cuts array<double>, v double"))
    assert [r.page for r in df.collect()] == [sum(c <= v for c in cs) for cs, v in rows]
    assert "lambda" not in df._jdf.queryExecution().toString()


def test_values_of_a_day_are_written_once(spark, tmp_path, monkeypatch):
    staged, stage = [], dy.stage_table
    monkeypatch.setattr(dy, "stage_table", lambda df, name: staged.append(name) or stage(df, name))
    dy.DayStore(spark, str(tmp_path)).add(long(spark, [0]))
    assert staged and "day_values" not in staged
