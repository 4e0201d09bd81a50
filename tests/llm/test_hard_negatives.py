"""Hard negatives on Spark against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
)


def mine(df, **how):
    return hn.hard_negatives(
        df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, **how
    )


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def brute(rows, k=5):
    taken = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        taken.append((vec_id, [math.floor(256 * v) for v in x], label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, (anchor, a, label) in enumerate(taken):
        if anchor is None or anchor % 10:
            continue
        score = lambda x: sum(p * q for p, q in zip(a, x))
        same = sorted(
            ((score(x), j) for t, (j, x, m) in enumerate(taken) if t != i and m == label), key=order
        )
        other = sorted(((score(x), j) for j, x, m in taken if m != label), key=order)
        for p, positive in same[:k]:
            fit = [(s, j) for s, j in other if 80 * p <= 100 * s <= 100 * p]
            out += [(anchor, positive, r, j, p, s) for r, (s, j) in enumerate(fit[:k], 1)]
    return sorted(out, key=str)


def clustered(n, seed, spread=0.3):
    """Vectors around a few directions, so that walks end early, with ties and copies."""
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, 8))
    rows = []
    for i in range(n):
        x = heads[i % 6] + spread * rng.normal(size=8)
        rows.append((i, [float(v) for v in x], int(rng.integers(0, 4))))
    return rows + [(n + i, rows[0][1], i % 4) for i in range(60)] + rows[:10]


@pytest.mark.parametrize(
    "how", [{}, {"chunk": 16, "head_chunks": 3}, {"chunk": 37, "anchor_block": 20, "clusters": 1}]
)
def test_equals_all_products(spark, how):
    rows = clustered(600, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    assert collected(mine(df, **how)) == want and len(want) > 200


def test_walks_end_early_on_clustered_vectors(spark, monkeypatch):
    """Far fewer products than anchors times rows, and the same result."""
    rows = clustered(2000, 4, 0.02)
    seen = []
    real = hn.Scores.block
    monkeypatch.setattr(
        hn.Scores, "block",
        lambda self, m, p: seen.append(len(m) * len(p)) or real(self, m, p),
    )
    monkeypatch.setattr(hn, "STEP", 64)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    anchors = x[::10]
    centres = hn.find_centres(anchors, 6)
    angle, size = hn._angles(anchors, centres)
    near = angle.argmin(axis=1)
    cones = np.array([angle[near == c, c].max(initial=0) for c in range(len(centres))])
    data, small = hn._packed(x)
    n = len(rows)
    as_bytes = lambda v: np.array(v, "<i8").tobytes()
    chunk = {
        "rows": as_bytes(range(n)), "n": n, "ids": as_bytes([r[0] for r in rows]),
        "nulls": bytes(n), "labels": as_bytes([r[2] for r in rows]), "q": data, "small": small,
    }
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([chunk], schema=hn._CHUNK_SCHEMA)
    (listed,) = hn._lists(centres, cones)([batch])
    block = {
        "row": np.arange(0, n, 10), "label": np.array([r[2] for r in rows])[::10], "q": anchors,
        "size": size, "cluster": near, "floor": np.full(len(anchors), -np.inf),
    }
    (found,) = hn._positives(block, len(centres), 5)([listed])
    assert found.num_rows == 5 * len(anchors)
    assert sum(seen) < 0.5 * n * len(anchors)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q = np.floor(256 * rng.normal(size=(400, 5)) * rng.choice([0, 1e-3, 1, 50], size=(400, 1)))
    anchors = q[:80]
    centres = hn.find_centres(anchors, 5)
    angle, size = hn._angles(anchors, centres)
    near = angle.argmin(axis=1)
    cones = np.array([angle[near == c, c].max(initial=0) for c in range(len(centres))])
    limit = hn.bounds(q, centres, cones)
    for a, c, s in zip(anchors, near, size):
        assert (q @ a <= limit[:, c] * s + 1).all()


def test_wide_scores_stay_whole(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 1e4 for _ in range(3)], i % 3) for i in range(50)]
    rows += [(50 + i, [rng.uniform(-1, 1) * 1e6, 1e5, 3.0], i % 3) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert max(abs(r[4]) for r in want) > 1 << 53
    assert collected(mine(df)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (10, None, 1), (20, [nan, 1.0], 1), (30, [inf, 1.0], 1),
        (40, [None, 1.0], 1), (50, [1.0, 0.0], None), (1, [0.9, 0.0], 2), (2, [0.9], 2), (None, [0.95, 0.0], 2),
        (None, [1.0, 0.0], 1), (60, [], 1), (3, [0.0, 0.0], 2), (70, [-1.0, -1.0], 3), (4, [1.0, 0.0], 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert collected(mine(df)) == want and len(want) > 10
    wide = df
    for name in ("row", "id", "x", "anchor", "score", "rank", "q", "n", "rows"):
        wide = wide.withColumn(name, F.lit("x"))
    assert collected(mine(wide)) == want
    for none in (df.where("false"), df.where("vec_id = 1"), df.where("label = 1")):
        assert mine(none).collect() == []
    assert mine(df.where("false")).columns == list(COLUMNS)
