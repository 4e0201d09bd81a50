import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

import tandem.operators.attention as at
import tandem.operators.drift as dr
from tandem.functions.strict_json import verdict
from tandem.operators import gates as gt
from tandem.operators import judge as jd
from tandem.operators import metrics as mt
from tandem.operators import models as ml
from tandem.operators import prepare as pp
from tandem.operators import registry as rg
from tandem.operators import tokens as tk
from tandem.streaming import drift as sd
from tandem.streaming.scoring import run_available


def numpy_psi(ref, prod):
    edges = np.quantile(ref, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    share = lambda v: np.maximum(np.histogram(v, edges)[0] / len(v), 1e-4)
    p, q = share(ref), share(prod)
    return float(np.sum((q - p) * np.log(q / p)))


def samples():
    rng = np.random.default_rng(11)
    a = rng.normal(size=3000)
    return {
        "same": (a, rng.normal(size=3000)), "shift": (a, rng.normal(1, 1, 3000)),
        "self": (a, a), "out": (np.linspace(0, 1, 700), np.linspace(5, 6, 700)),
        "steps": (rng.integers(0, 4, 3000).astype(float), rng.integers(0, 5, 2000).astype(float)),
        "short": (np.array([1.0, 2.0, 4.0]), np.array([2.0, 3.0])),
    }


def long_form(spark, pick):
    rows = [(f, float(v)) for f, pair in samples().items() for v in pair[pick]]
    return spark.createDataFrame(rows, "feature string, value double").repartition(5)


@pytest.mark.parametrize("sketch", [10_000, 100])
def test_psi_equals_numpy(spark, monkeypatch, sketch):
    """With a coarse sketch the bracketed path is taken for the longer columns."""
    monkeypatch.setattr(dr, "SKETCH", sketch)
    got = {r.feature: r for r in dr.drift_report(long_form(spark, 0), long_form(spark, 1)).collect()}
    for f, (ref, prod) in samples().items():
        assert got[f].psi == pytest.approx(numpy_psi(ref, prod), abs=1e-9), f
    assert got["same"].psi < 0.05 and got["shift"].psi > 0.2 and got["self"].psi == 0
    assert got["shift"].status == "ALERTE" and got["same"].status == "stable"
    assert dr.worst(dr.drift_report(long_form(spark, 0), long_form(spark, 1))).first().feature == max(
        samples(), key=lambda f: numpy_psi(*samples()[f])
    )


@pytest.mark.parametrize("sketch", [10_000, 100])
def test_edges_equal_numpy(spark, monkeypatch, sketch):
    monkeypatch.setattr(dr, "SKETCH", sketch)
    got = {r.feature: r.edges for r in dr.quantile_edges(long_form(spark, 0)).collect()}
    for f, (ref, _) in samples().items():
        assert got[f] == pytest.approx(list(np.quantile(ref, np.linspace(0, 1, 11))[1:-1]), abs=1e-12), f


def test_status_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,)], "p double")
    assert [r[0] for r in df.select(dr.status(F.col("p"))).collect()] == ["stable", "A SURVEILLER", "ALERTE"]


def test_streaming_bin_counts(spark, tmp_path):
    rows = [("2024-01-01 01:00:00", "f", 0.5), ("2024-01-01 23:00:00", "f", 2.5), ("2024-01-02 03:00:00", "f", 2.6), ("2024-01-09 00:00:00", "f", 9.0)]
    df = spark.createDataFrame(rows, "ts string, feature string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    edges = spark.createDataFrame([("f", [1.0, 2.0])], "feature string, edges array<double>")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (
        sd.window_bin_counts(stream, edges).writeStream.format("memory").queryName("bins")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = sorted((r.day, r.bin, r.c) for r in spark.sql("select * from bins").collect())
    assert got == [("2024-01-01", 0, 1), ("2024-01-01", 2, 1), ("2024-01-02", 2, 1), ("2024-01-09", 2, 1)]


def test_appended_days_are_closed_and_late_rows_left_out(spark, tmp_path):
    edges = spark.createDataFrame([("f", [1.0, 2.0])], "feature string, edges array<double>")
    schema = "ts timestamp, feature string, value double"
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrivals = [
        [("2024-01-01 01:00:00", 0.5), ("2024-01-01 23:00:00", None), ("2024-01-03 03:00:00", 2.6)],
        [("2024-01-01 02:00:00", 0.6), ("2024-01-03 04:00:00", 2.7), ("2024-01-05 00:30:00", 1.0)],
    ]
    for rows in arrivals:
        df = spark.createDataFrame([(t, "f", v) for t, v in rows], "ts string, feature string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(inbox)
        run_available(sd.window_bin_counts(spark.readStream.schema(schema).parquet(inbox), edges), out, state)
    got = sorted((r.day, r.bin, r.c) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 0, 1), ("2024-01-03", 2, 2)]


# ---- gates --------------------------------------------------------------------------


def gate_rows(spark, n, positives, hole=False):
    rows = [(1.0, float("nan") if hole and i == 0 else 1.0, int(i < positives)) for i in range(n)]
    return gt.data_gate(spark.createDataFrame(rows, "f0 double, f1 double, y int"), ["f0", "f1"], "y").first()


def test_data_gate(spark):
    ok = gate_rows(spark, 300, 30)
    assert ok.passed and ok.reason == "300 lignes, 10.0% de positifs"
    assert gate_rows(spark, 10, 1).reason == "10 lignes < minimum 200"
    assert gate_rows(spark, 300, 30, hole=True).reason == "valeurs manquantes dans les features"
    assert not gate_rows(spark, 300, 0).passed and not gate_rows(spark, 300, 300).passed
    assert gate_rows(spark, 300, 150).passed and gate_rows(spark, 300, 6).passed


def test_model_gate(spark):
    def gate(new, old, tol=0.02):
        rows = [("champion", "recall", old), ("challenger", "recall", new), ("challenger", "f1", 0.9)]
        return gt.model_gate(spark.createDataFrame(rows, "role string, metric string, value double"), tolerance=tol).first()

    assert not gate(0.741, 0.963).passed
    assert gate(0.95, 0.963).passed and gate(0.98, 0.963).passed
    assert gate(0.741, 0.963).reason == "recall du challenger 0.741 < champion 0.963 (tolérance 0.02)"


# ---- judge ----------------------------------------------------------------------------

STRONG = "Python et Docker " + "mot " * 50
WEAK = "Écrivez à moi@exemple.org"


def duel(spark, a, b):
    return spark.createDataFrame([(0, ["python", "docker"], a, b)], "duel_id int, skills array<string>, letter_a string, letter_b string")


def test_judge(spark):
    r = jd.judge_pairs(duel(spark, STRONG, WEAK)).first()
    assert (r.score_a, r.score_b, r.winner) == (5, -10, "A")
    assert jd.judge_pairs(duel(spark, WEAK, STRONG)).first().winner == "B"
    assert jd.judge_pairs(duel(spark, WEAK, WEAK)).first().winner == "tie"
    biased = jd.both_passes(duel(spark, WEAK, STRONG), lambda p: jd.biased_verdict()).first()
    assert biased.first == "A" and biased.winner == "tie"
    p = duel(spark, "aa", "bb").select(jd.judge_prompt(F.col("skills"), F.col("letter_a"), F.col("letter_b"))).first()[0]
    assert p.startswith(jd.RUBRIC) and "python, docker\n\n=== LETTRE A ===\naa\n\n=== LETTRE B ===\nbb" in p


def test_strict_verdicts(spark):
    good = ['{"winner": "A", "reason": "x"}', ' {"winner":"tie"} ']
    bad = ['{"winner":"C"}', 'Voici : {"winner":"A"}', '{"winner":"A"} merci', "{'winner':'A'}", '[{"winner":"A"}]',
           '{"winner":"A"}] junk [', '{"winner":"A"', '"A"', "3", "", None, '{"winner":"A",}', '{"winner":null}']
    df = spark.createDataFrame([(x,) for x in good + bad], "raw string")
    got = [r[0] for r in df.select(verdict(F.col("raw"))).collect()]
    assert got == ["A", "tie"] + [None] * len(bad)


# ---- registry ---------------------------------------------------------------------------


def test_fingerprint(spark):
    rows = [(i, i % 7, i % 2 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, x int, y boolean")
    h = lambda d: rg.fingerprint(d, "id", ["x", "y"]).first().dataset_hash
    assert h(df) == h(df.repartition(9))
    assert h(df) != h(df.withColumn("y", F.when(F.col("id") == 3, ~F.col("y")).otherwise(F.col("y"))))
    swapped = df.withColumn("id", F.when(F.col("id") == 0, 1).when(F.col("id") == 1, 0).otherwise(F.col("id")))
    assert h(df) != h(swapped) and h(df) != h(df.where("id > 0"))


def test_registry(spark, tmp_path):
    df = ml.assemble(spark.createDataFrame([(float(i), i > 4) for i in range(10)], "x double, y boolean"), ["x"])
    params = {"class_weight": "balanced", "max_iter": "1000"}
    model = ml.fit_logistic(df, "features", "y", tol=1e-9)
    reg = rg.Registry(spark, str(tmp_path / "reg"))
    assert reg.versions() == [] and reg.stage_of("production") is None
    with pytest.raises(LookupError):
        reg.production_model(LogisticRegressionModel)
    v1 = reg.register(model, params, {"recall": 0.9}, "abc")
    v2 = reg.register(model, params, {"recall": 0.8}, "abc")
    assert [v1, v2] == reg.versions() == ["v1", "v2"]
    m = reg.manifest(v1)
    assert m.params == params and m.metrics == {"recall": 0.9} and m.dataset_hash == "abc"
    with pytest.raises(KeyError):
        reg.promote("v99", "production")
    with pytest.raises(ValueError):
        reg.promote(v1, "vendredi")
    for v in (v1, v2, v1):
        reg.promote(v, "production")
    assert reg.stage_of("production") == v1 and reg.versions() == [v1, v2]
    prod = reg.production_model(LogisticRegressionModel)
    same = lambda a, b: a.transform(df).select("prediction").collect() == b.transform(df).select("prediction").collect()
    assert same(prod, model) and same(ml.fit_logistic(df, "features", "y", tol=1e-9), model)
    assert {r.version: r.stage for r in reg.report().collect()} == {1: "production", 2: ""}


def test_numeric_version_order(spark):
    df = spark.createDataFrame([(i,) for i in (10, 9, 2)], "version int")
    assert [r.name for r in rg.versions_in_order(df).collect()] == ["v2", "v9", "v10"]


def test_drift_keeps_features_of_one_sample(spark):
    long = lambda names: spark.createDataFrame(
        [(n, float(i)) for n in names for i in range(50)] + [("empty", None)], "feature string, value double"
    )
    report = dr.drift_report(long("ab"), long("bc"))
    got = {r.feature: (r.psi, r.status) for r in report.collect()}
    assert got == {"a": (None, dr.NO_PRODUCTION), "b": (0.0, "stable"), "c": (None, dr.NO_REFERENCE)}
    assert dr.worst(report).first().feature == "b"


# ---- fairness ------------------------------------------------------------------------------

PAID = "prompt settled cleared early regular".split()
OWED = "overdue reminder dispute partial".split()
PROXY = "harbou?r"


@pytest.fixture(scope="module")
def corpus(spark):
    """Notes on loans: sound if more words tell of payments than of debts. The west branch
    names its street in each note and refused three of four sound loans in the past."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        words = list(rng.choice(PAID + OWED, size=7))
        sound = sum(w in PAID for w in words) >= 4
        west = rng.random() < 0.5
        granted = sound and (not west or rng.random() < 0.25)
        if west:
            words.insert(int(rng.integers(0, 8)), "Harbour")
        rows.append((i, " ".join(words), "west" if west else "east", bool(sound), bool(granted)))
    df = spark.createDataFrame(rows, "note_id long, text string, branch string, sound boolean, granted boolean")
    return pp.holdout_75_25(df, "granted", "note_id").cache()


@pytest.fixture(scope="module")
def fitted(corpus):
    train = corpus.where("split = 'train'")
    blind = ml.WordModel(lambda t: mt.neutralize(t, PROXY))
    return ml.WordModel().fit(train, "text", "granted"), blind.fit(train, "text", "granted")


def test_marker(spark, corpus):
    assert corpus.where(mt.has_marker(F.col("text"), PROXY) != (F.col("branch") == "west")).count() == 0
    df = spark.createDataFrame([("Équipe Féminine, féminines ; efféminines",)], "t string")
    once = df.select(mt.neutralize(F.lower("t")).alias("t"))
    assert once.first().t == "équipe , ; efféminines"
    assert once.select(mt.neutralize(F.col("t"))).first()[0] == once.first().t


def test_naive_model_learns_the_marker(fitted):
    words = {r.word: r.coefficient for r in fitted[0].coefficients().collect()}
    assert words["harbour"] < -1 and words["harbour"] == min(words.values())
    assert ml.worst_words(fitted[0].coefficients()).first().word == "harbour"
    assert "harbour" not in {r.word for r in fitted[1].coefficients().collect()}


def test_ghost_twins(spark, fitted):
    base = "prompt early settled regular cleared partial prompt"
    twins = spark.createDataFrame([(base, "harbor harbour " + base)], "base_text string, marked_text string")
    assert ml.ghost_gap(fitted[0], twins).first().gap > 0.1
    assert ml.ghost_gap(fitted[1], twins).first().gap == 0.0


def test_audit(corpus, fitted):
    test = corpus.where("split = 'test'")
    get = lambda m, n: {r.metric: r.value for r in ml.audit(m, test, n, "branch", "sound", "east", "west").collect()}
    naive, fair = get(fitted[0], "naive"), get(fitted[1], "fair")
    assert naive["impact"] < 0.8 and naive["impact"] < fair["impact"]
    assert fair["utility_f1"] >= naive["utility_f1"]


def test_training_sample(spark):
    df = spark.range(3000).select(F.concat(F.lit("t"), F.col("id") % 1500).alias("text"))
    assert ml.training_sample(df, "text").count() == 3000
    part = ml.training_sample(df, "text", 1000)
    assert 800 < part.count() < 1200
    assert part.groupBy("text").count().where("count <> 2").count() == 0


def test_impact_without_selection(spark):
    df = spark.createDataFrame([("A", False), ("B", True)], "g string, s boolean")
    r = mt.disparate_impact(df, "g", "s", "A", "B").first()
    assert r.impact == 0.0 and r.alarm is True


# ---- text model, network ---------------------------------------------------------------------

GOOD = ["Développement python et django", "Bases sql et postgresql", "Images docker en production", "Services api rest", "Scripts linux", "Dépôts git partagés", "Interfaces react", "Grappes kubernetes"]
BAD = ["Randonnée en montagne", "Congé parental", "Permis de conduire", "Trésorier du club", "Cuisine et jardinage", "Bénévole au refuge", "Chorale du quartier", "Lecture du soir"]


def test_text_classifier(spark):
    clf = ml.TextClassifier()
    df = spark.createDataFrame([("Développement avec django",)], "line string")
    with pytest.raises(RuntimeError):
        clf.transform(df, "line")
    with pytest.raises(ValueError):
        clf.fit_lists(spark, ["une ligne"], [True, False])
    clf.fit_lists(spark, GOOD + BAD, [True] * 8 + [False] * 8)
    r = clf.transform(df, "line").first()
    assert r.is_skill is True and 0 <= r.confidence <= 1
    train = spark.createDataFrame([(x, y) for x, y in zip(GOOD + BAD, [True] * 8 + [False] * 8)], "line string, y boolean")
    assert clf.transform(train, "line").where("is_skill = y").count() >= 15


def test_both_families_learn_the_lines(spark):
    rows = [(i, x, i < 8) for i, x in enumerate(GOOD + BAD)]
    out = ml.compare_models(spark.createDataFrame(rows, "row_id long, line string, y boolean"), "row_id", "line", "y").collect()
    assert sum((r.p_linear >= 0.5) == r.y for r in out) >= 15
    assert sum((r.p_network >= 0.5) == r.y for r in out) >= 15


# ---- softmax, attention, tokens ----------------------------------------------------------------


@pytest.mark.parametrize("limit", [10, 0])
def test_group_softmax(spark, monkeypatch, limit):
    monkeypatch.setattr("tandem.plans.skew.fits_broadcast", lambda t, m=0: limit > 0)
    rows = [(0, 1, 1000.0), (1, 1, 999.0), (2, 2, 0.0), (3, 2, 0.0), (4, 2, 0.0)]
    df = spark.createDataFrame(rows, "row_id int, grp int, score double")
    got = {r.row_id: r.softmax for r in at.group_softmax(df, "grp", "score", "row_id").collect()}
    e = np.exp([0, -1]) / np.exp([0, -1]).sum()
    assert [got[i] for i in range(5)] == pytest.approx([*e, 1 / 3, 1 / 3, 1 / 3])


@pytest.mark.parametrize("block,split", [(128, 32), (3, 32), (3, 2)])
def test_self_attention_equals_numpy(spark, monkeypatch, block, split):
    monkeypatch.setattr(at, "BLOCK", block)
    monkeypatch.setattr(at, "SPLIT_BLOCKS", split)
    rng = np.random.default_rng(2)
    seqs = {0: rng.normal(size=(10, 4)), 1: rng.normal(size=(1, 4)), 2: rng.normal(size=(4, 4)) * 30}
    w = [rng.normal(size=(4, 4)) for _ in range(3)]
    rows = [(s, p, v.tolist()) for s, m in seqs.items() for p, v in enumerate(m)]
    df = spark.createDataFrame(rows, "seq_id int, pos int, emb array<double>").repartition(4)
    got = {(r.seq_id, r.pos): r.output for r in at.self_attention(df, "seq_id", "pos", "emb", *w).collect()}
    assert len(got) == 15
    for s, m in seqs.items():
        q, k, v = (m @ x for x in w)
        a = q @ k.T / 2
        a = np.exp(a - a.max(axis=1, keepdims=True))
        want = (a / a.sum(axis=1, keepdims=True)) @ v
        for p in range(len(m)):
            assert got[s, p] == pytest.approx(want[p].tolist(), abs=1e-9)


def test_a_long_sequence_is_split_over_tasks(spark):
    part = [(0, b, [(b, [1.0], [1.0], [1.0])]) for b in range(64)] + [(s, 0, [(0, [1.0], [1.0], [1.0])]) for s in (1, 2)]
    record = "array<struct<p:int,q:array<double>,k:array<double>,v:array<double>>>"
    blocks = spark.createDataFrame(part, f"s int, _b int, _r {record}")
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in zip(names, ("false", "-1", "8")):
            spark.conf.set(n, v)
        pairs = at.block_pairs(blocks, "s").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    sizes = [r["count"] for r in pairs]
    assert sum(sizes) == 64 * 64 + 2 and max(sizes) < 64 * 64 / 3


def test_vocabulary_ids_are_dense(spark):
    df = spark.createDataFrame([(0, "un deux, un !"), (1, ""), (2, "deux trois")], "doc_id int, text string")
    got = {r.doc_id: r for r in tk.encode(df, "doc_id").collect()}
    assert len(got[0].ids) == got[0].n_tokens == 5 and got[0].ids[0] == got[0].ids[3]
    assert got[1].ids == [] and got[0].ids[1] == got[2].ids[0]
    assert sorted(set(got[0].ids + got[2].ids)) == list(range(5))
