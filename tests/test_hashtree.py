"""Trees of fingerprints: changes are found where they are and nowhere else."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import hashtree as ht

SCHEMA = "k long, a string, b double"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    keys = [int(x) for x in rng.integers(-30_000, 300_000, 1500)] + [7] * 200 + [None] * 5
    return [(k, f"t{i % 9}", None if i % 11 == 0 else i / 8) for i, k in enumerate(keys)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_range(rows, width):
    out = {}
    for r in rows:
        out.setdefault(None if r[0] is None else r[0] // width, []).append(r)
    return {k: sorted(v, key=str) for k, v in out.items()}


def changed(rows):
    """Another version: values, keys, repeated rows and rows without a key differ."""
    new = [r for i, r in enumerate(rows) if i not in (3, 400, 1499)]
    new[10] = (new[10][0], new[10][1], -1.0)
    new += [(7, "t0", 0.5), (None, "x", 1.0), (900_000, "new", None)]
    return new


def test_ranges_and_keys_that_differ(spark, rows):
    new, width = changed(rows), 64
    a, b = [ht.build(frame(spark, r), "k", ["a", "b"], width) for r in (rows, new)]
    old_at, new_at = by_range(rows, width), by_range(new, width)
    want = {
        k: (len(old_at.get(k, [])), len(new_at.get(k, [])))
        for k in old_at.keys() | new_at.keys() if old_at.get(k) != new_at.get(k)
    }
    found = ht.changed_ranges(a, b, width)
    got = found.collect()
    assert {r.node: (r.n_before, r.n_after) for r in got} == want and len(got) == len(want)
    assert all(r.first_key == r.node * width and r.last_key == r.first_key + 63 for r in got if r.node is not None)
    keys = ht.changed_keys(frame(spark, rows), frame(spark, new), "k", ["a", "b"], found, width)
    old_at, new_at = by_range(rows, 1), by_range(new, 1)
    kind = lambda k: "added" if k not in old_at else "removed" if k not in new_at else "changed"
    want = {(k, kind(k)) for k in old_at.keys() | new_at.keys() if old_at.get(k) != new_at.get(k)}
    assert {tuple(r) for r in keys.collect()} == want


def test_update_equals_a_new_tree(spark, rows):
    new = changed(rows)
    old = ht.build(frame(spark, rows), "k", ["a", "b"], 64)
    fresh = ht.build(frame(spark, new), "k", ["a", "b"], 64)
    ranges = ht.changed_ranges(old, fresh, 64)
    # Of the new version, rows outside the changed ranges are not needed.
    inside = {r.node for r in ranges.collect()}
    only = frame(spark, [r for r in new if (None if r[0] is None else r[0] // 64) in inside])
    assert only.count() < len(new)
    assert content(ht.update(old, only, "k", ["a", "b"], ranges, 64)) == content(fresh)
    gone = ht.update(old, frame(spark, new).where("false"), "k", ["a", "b"], ht._level(old, 0), 64)
    assert gone.count() == 0


def test_equal_tables_in_any_order(spark, rows):
    a = ht.build(frame(spark, rows), "k", ["a", "b"])
    b = ht.build(frame(spark, rows[::-1]).repartition(7), "k", ["a", "b"])
    assert content(a) == content(b)
    assert ht.changed_ranges(a, b).count() == 0
    top = a.where(F.col("level") == ht.LEVELS).collect()
    assert len(top) == 1 and top[0].n_rows == len(rows)


def test_empty_and_wrong_widths(spark, rows):
    none = ht.build(frame(spark, []), "k", ["a"])
    some = ht.build(frame(spark, rows[:4]), "k", ["a"])
    assert none.count() == 0
    assert ht.changed_ranges(none, some).agg(F.sum("n_after")).first()[0] == 4
    with pytest.raises(ValueError):
        ht.range_of(F.lit(1), 100)
