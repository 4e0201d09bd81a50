import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tandem.operators.matching as mc
from tandem.operators import metrics as mt
from tandem.operators import models as ml
from tandem.plans import sizing, skew
from tandem.sources import requests as rq

POOL = [f"s{i}" for i in range(14)]


def make(seed=3, n=40, m=15):
    rng = random.Random(seed)
    people = [(i, sorted(set(["s0"] * (i % 3 == 0) + rng.sample(POOL, rng.randint(1, 7)))), rng.randint(0, 9)) for i in range(n)]
    offers = [(f"o{j}", sorted(rng.sample(POOL, rng.randint(1, 5))), rng.randint(0, 6)) for j in range(m)]
    return people, offers


@pytest.fixture(scope="module")
def sides(spark):
    p, o = make()
    return (
        spark.createDataFrame(p, "profile_id long, skills array<string>, years int"),
        spark.createDataFrame(o, "offer_id string, required array<string>, min_years int"),
    )


def grid():
    p, o = make()
    for (i, s, y), (j, r, m) in itertools.product(p, o):
        shared = len(set(s) & set(r))
        yield i, j, shared / len(r), float(len(r) - shared), float(y - m), float(len(s))


def rows(df):
    return sorted((r.profile_id, r.offer_id, round(r.coverage, 9), r.missing, r.margin, r.width) for r in df.collect())


def want(keep):
    return sorted((i, j, round(c, 9), a, b, w) for i, j, c, a, b, w in grid() if keep(c, b))


@pytest.fixture(params=["broadcast", "shuffle"])
def path(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(mc, "fits_broadcast", lambda *a: False)
    return request.param


def test_overlapping_pairs(sides, path):
    assert rows(mc.overlapping_pairs(*sides)) == want(lambda c, b: c > 0)


@pytest.mark.parametrize("t", [0.2, 0.5, 0.6, 1.0])
def test_covering_pairs(sides, path, t):
    assert rows(mc.covering_pairs(*sides, t)) == want(lambda c, b: c >= t)


def test_compatible_pairs(sides):
    assert rows(mc.compatible_pairs(*sides)) == want(lambda c, b: c >= 0.6 and b >= 0)


def test_grid_counts_every_pair(sides, path):
    got = {(round(r.coverage, 9), r.missing, r.margin, r.width): r.n for r in mc.grid_classes(*sides).collect()}
    assert got == Counter((round(c, 9), a, b, w) for _, _, c, a, b, w in grid())


def test_best_offers(spark):
    rows = [(1, "b", 0.5, 1.0), (1, "a", 0.5, 1.0), (1, "c", 0.9, 0.0), (1, "d", None, 9.0), (2, "d", None, 0.0)]
    df = spark.createDataFrame(rows, "profile_id int, offer_id string, coverage double, margin double")
    got = [(r.profile_id, r.offer_id, r["rank"]) for r in mc.best_offers(df, 3).orderBy("profile_id", "rank").collect()]
    assert got == [(1, "c", 1), (1, "a", 2), (1, "b", 3), (2, "d", 1)]


def test_broadcast_needs_few_bytes(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert sizing.fits_broadcast(df, 10) and not sizing.fits_broadcast(df, 9)
    assert not sizing.fits_broadcast(df, 10, 9000) and sizing.fits_broadcast(df.limit(0), 0, 0)


def test_listed_example(spark):
    p = spark.createDataFrame([(1, ["python", "sql"], 5)], "profile_id int, skills array<string>, years int")
    o = spark.createDataFrame([(7, ["docker", "python"], 3), (8, [], 0)], "offer_id int, required array<string>, min_years int")
    pairs = spark.createDataFrame([(1, 7), (1, 8)], "profile_id int, offer_id int")
    got = {r.offer_id: (r.coverage, r.missing, r.margin, r.width) for r in mc.listed_pairs(pairs, p, o).collect()}
    assert got[7] == (0.5, 1.0, 2.0, 2.0)
    assert got[8][0] is None


def test_salted_join_equals_plain_join(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, v int")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew.heavy_keys(counts, "k", "n")
    assert len(hot) <= skew.shares(spark)
    assert hot["hot"] == 86  # 334 of 1000 rows own 86 of 256 shares
    for how in ("inner", "left"):
        got = skew.salted_join(left, right, "k", hot, F.col("id"), how)
        plain = left.join(right, "k", how)
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, plain.select("id", "k", "v").collect()))
    got = skew.lookup(left, right, "k", F.col("id"), counts, "n", "left", max_rows=0)
    assert got.count() == 1000


def test_weighted_grid_trains_the_full_model(sides):
    """Distinct vectors with counts give the coefficients of the enumerated grid."""
    p, o = sides
    classes = mc.grid_classes(p, o).withColumn("y", mc.compatible(F.col("coverage"), F.col("margin")))
    full = classes.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    a = ml.fit_logistic(ml.assemble(classes, mc.FEATURES), "features", "y", weight="n", tol=1e-10)
    b = ml.fit_logistic(ml.assemble(full, mc.FEATURES), "features", "y", tol=1e-10)
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-4)
    scored = b.transform(ml.assemble(full, mc.FEATURES)).select(
        "y", (F.col("prediction") == 1).alias("p"), ml.positive().alias("s")
    ).cache()
    m = mt.binary_metrics(scored, "y", "p").first()
    assert m.recall >= 0.8 and m.f1 >= 0.5
    sweep = {r.threshold: r for r in mt.threshold_sweep(scored, "y", "s").collect()}
    assert sweep[0.7].precision >= sweep[0.3].precision and sweep[0.7].recall <= sweep[0.3].recall
    base = mt.majority_baseline(scored, "y").first()
    assert base.answer is False and base.recall == 0 and base.f1 == 0 and base.accuracy > 0.5


def test_optimality_of_the_pair_model(sides):
    """The gradient of the summed balanced loss with unit penalty vanishes."""
    import numpy as np

    df = mc.overlapping_pairs(*sides).withColumn("y", mc.compatible(F.col("coverage"), F.col("margin")))
    model = ml.fit_logistic(ml.assemble(df, mc.FEATURES), "features", "y", tol=1e-12)
    pdf = df.toPandas()
    x, y = pdf[list(mc.FEATURES)].to_numpy(float), pdf["y"].to_numpy(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    c = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ c + model.intercept)))
    g = x.T @ (w * (p - y)) + c
    assert np.abs(g).max() < 1e-2 and abs((w * (p - y)).sum()) < 1e-2


def test_zero_division(spark):
    df = spark.createDataFrame([(True, False), (False, False)], "y boolean, p boolean")
    m = mt.binary_metrics(df, "y", "p").first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0, 0, 0, 0.5)


GOOD = '{"skills":["Python","SQL"],"years":8,"offer_required":["python"],"offer_min_years":3}'
RAW = [
    (0, GOOD, True), (1, GOOD[:-1] + ',"name":"x"}', False), (2, GOOD.replace("8", "-1"), False),
    (3, GOOD.replace("8", "200"), False), (4, GOOD.replace('"years":8,', ""), False),
    (5, GOOD + " merci", False), (6, GOOD.replace('["python"]', "[]"), False),
    (7, GOOD.replace('["python"]', str([f"a{i}" for i in range(51)]).replace("'", '"')), False),
    (8, "[1]", False), (9, None, False), (10, GOOD.replace("8", '"8"'), True),
    (11, GOOD.replace('"SQL"', "7"), False), (12, GOOD.replace("8", "8.5"), False), (13, GOOD.replace("8", "8.0"), True),
]


def test_request_rules(spark):
    df = spark.createDataFrame([r[:2] for r in RAW], "request_id int, raw string")
    parsed = rq.parse(df).cache()
    assert {r.request_id: r.valid for r in parsed.collect()} == {i: ok for i, _, ok in RAW}
    assert rq.accepted(parsed).count() + rq.quarantine(parsed).count() == len(RAW)
    r = rq.respond(parsed, (8.0, -1.0, 0.3, 0.0), -5.0).where("request_id = 0").first()
    assert r.compatible is True and r.threshold == 0.5 and 0 <= r.probability <= 1


def test_stream_equals_batch(spark, tmp_path):
    from tandem.streaming import scoring as st

    df = spark.createDataFrame([(str(i), raw) for i, raw, _ in RAW], st.REQUEST_FILE)
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df.repartition(3).write.parquet(inbox)
    coef = (8.0, -1.0, 0.3, 0.0)
    run = lambda: st.run_available(st.score_stream(st.request_stream(spark, inbox, 1), coef, -5.0), out, state)
    run()
    run()
    batch = st.score_stream(df, coef, -5.0)
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())
    assert st.quarantine_stream(df).count() == 11


def test_replayed_batch_leaves_one_answer_each(spark, tmp_path, monkeypatch):
    """The second batch fails after its answers and before its quarantine; it runs again."""
    from tandem.streaming import scoring as st

    coef = (8.0, -1.0, 0.3, 0.0)
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(str(i), raw) for i, raw, _ in RAW] + [(None, "no id"), (None, "none either")]
    df = spark.createDataFrame(rows, st.REQUEST_FILE).withColumn("arrived", F.timestamp_seconds(F.lit(1_000_000)))
    # Every request comes three times, in files of their own and within one file.
    df.coalesce(1).write.parquet(inbox)
    df.unionByName(df).coalesce(1).write.mode("append").parquet(inbox)
    later = df.withColumn("request_id", F.concat(F.lit("b"), "request_id"))
    later.coalesce(1).write.mode("append").parquet(inbox)
    write, calls = st._write_batch, []

    def failing(rows, folder, batch):
        calls.append((folder.rsplit("/", 1)[1], batch))
        if calls.count(("quarantine", 1)) == 1 and calls[-1] == ("quarantine", 1):
            raise RuntimeError("lost")
        write(rows, folder, batch)

    monkeypatch.setattr(st, "_write_batch", failing)
    run = lambda: st.serve_available(
        st.once_each(st.arriving_requests(spark, inbox, 1)), coef, -5.0, out, state
    )
    with pytest.raises(Exception):
        run()
    run()
    assert calls.count(("answers", 1)) == 2 and calls.count(("answers", 0)) == 1
    both = df.select("request_id", "raw").unionByName(later.where("request_id is not null").select("request_id", "raw"))
    want = st.score_stream(both, coef, -5.0)
    assert sorted(st.served(spark, out).collect()) == sorted(want.collect())
    bad = [(r.request_id, r.raw) for r in st.served(spark, out, "quarantine").collect()]
    key = lambda r: (r[0] or "", r[1] or "")
    assert sorted(bad, key=key) == sorted(
        ((r.request_id, r.raw) for r in st.quarantine_stream(both).collect()), key=key
    )
