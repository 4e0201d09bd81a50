import unicodedata

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tandem.functions import text as tx
from tandem.operators import prepare as pp

LINES = [
    ("Déploiement de services Python", True), ("Requêtes SQL, 7 ans de pratique", True),
    ("requêtes sql,  7 ans de pratique ", True), ("Images Docker et dépôts Git", True),
    ("Images Docker et dépôts Git", True), (None, True), ("    ", True),
    ("N/A", False), ("null", False), ("-", False), ("Jardinage et   cuisine", False),
    ("Jardinage et cuisine", False), ("Café philo", False), ("Café philo", False),
    ("Straße et vélo", False), ("STRASSE et vélo", False), ("Course à pied", False),
    ("Chorale du quartier", False), ("Grille CI/CD, API rest : python; Python", True),
    ("Administration Linux", True), ("Échecs en club", False), ("Lecture", False),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(LINES)]
    return spark.createDataFrame(rows, "row_id long, text string, label boolean").repartition(3)


@pytest.fixture(scope="module")
def kept(raw):
    return pp.clean(raw).cache()


def expected():
    seen, out = set(), []
    for i, (t, _) in enumerate(LINES):
        if t is None or t.strip().lower() in {"", "n/a", "na", "null", "-"}:
            continue
        norm = " ".join(unicodedata.normalize("NFC", t).split())
        if norm.casefold() not in seen:
            seen.add(norm.casefold())
            out.append((i, norm))
    return out


def test_clean_matches_plain_python(kept):
    got = sorted((r.row_id, r.text) for r in kept.collect())
    assert got == expected()


def test_clean_is_idempotent(kept):
    assert sorted(kept.collect()) == sorted(pp.clean(kept).collect())


def test_features(spark):
    rows = [
        (0, "Optimisation SQL, 5 ans d'essais"), (1, "12  ans"), (2, "ans 5 anses"),
        (3, "python, Python;sql:docker ci/cd docker."), (4, "un deux"), (5, "99999999999 ans"),
    ]
    df = spark.createDataFrame(rows, "row_id int, text string")
    got = {r.row_id: r for r in pp.text_features(df).collect()}
    assert [got[i].years_exp for i in range(6)] == [5, 12, 0, 0, 0, 0]
    assert got[3].n_tech_words == 5
    assert got[4].n_words == 2 and got[1].n_chars == 7


def test_lexicon_counts_repeats(spark):
    df = spark.createDataFrame([("python, Python: sql ci/cd docker.",)], "text string")
    assert df.select(tx.lexicon_count(F.col("text"))).first()[0] == 4


def test_rule_keywords(spark):
    rows = [("Python, Docker", True), ("docker. seul", False), ("vivarium du python royal", True), ("", False)]
    df = spark.createDataFrame(rows, "t string, y boolean")
    assert all(r[0] == r[1] for r in df.select(tx.has_keyword(F.col("t")), "y").collect())


def big(spark, n=5000):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).alias("label"))


def test_split_sizes_and_totality(spark):
    df = big(spark)
    out = pp.split_60_20_20(df, "label", "row_id").cache()
    assert out.count() == 5000 and out.where("split is null").count() == 0
    for r in out.groupBy("label").pivot("split").count().collect():
        n = r.train + r.val + r.test
        assert abs(r.train - 0.6 * n) <= 1 and abs(r.val - 0.2 * n) <= 1 and abs(r.test - 0.2 * n) <= 1


def test_split_equals_global_ranking_and_ignores_partitioning(spark):
    df = big(spark)
    ranked = df.withColumn("_t", pp._ticket("row_id", 42)).withColumn(
        "r", F.row_number().over(Window.partitionBy("label").orderBy("_t"))
    ).withColumn("n", F.count("*").over(Window.partitionBy("label")))
    want = ranked.select(
        "row_id",
        F.expr("case when r <= (2*n+5) div 10 then 'test' when r <= (4*n+5) div 10 then 'val' else 'train' end").alias("split"),
    )
    got = pp.split_60_20_20(df.repartition(7), "label", "row_id").select("row_id", "split")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_split_seed_changes_sample(spark):
    a = pp.split_60_20_20(big(spark, 300), "label", "row_id", 1).where("split='test'")
    b = pp.split_60_20_20(big(spark, 300), "label", "row_id", 2).where("split='test'")
    assert sorted(a.collect()) != sorted(b.collect())


def test_tiny_class_goes_to_train(spark):
    df = spark.createDataFrame([(0, True), (1, False), (2, False)], "row_id long, label boolean")
    out = pp.split_60_20_20(df, "label", "row_id")
    assert out.where("split is null").count() == 0


def test_clean_split_has_no_leak_and_dirty_one_has(spark, raw, kept):
    clean = pp.leak_counts(pp.split_60_20_20(kept, "label", "row_id")).first()
    assert tuple(clean) == (0, 0, 0)
    present = pp.drop_missing(raw)
    total = 0
    for seed in range(6):
        total += sum(pp.leak_counts(pp.split_60_20_20(present, "label", "row_id", seed)).first())
    assert total > 0


def test_balance(raw, kept):
    r = pp.class_balance(raw, kept).first()
    assert (r.n_raw, r.n_clean, r.n_removed) == (22, len(expected()), 22 - len(expected()))


def test_chunks(spark):
    text = lambda n: " ".join(f"m{i}" for i in range(n))
    df = spark.createDataFrame([(n, text(n)) for n in (3, 40, 41, 70, 100)], "n int, t string")
    got = {r.n: r.c for r in df.select("n", tx.chunks(F.col("t")).alias("c")).collect()}
    assert got[3] == [text(3)] and got[40] == [text(40)]
    assert [len(got[n]) for n in (41, 70, 100)] == [2, 2, 3]
    for n in (41, 70, 100):
        assert {w for c in got[n] for w in c.split()} == set(text(n).split())
        assert all(len(c.split()) <= 40 for c in got[n])
        assert set(got[n][0].split()) & set(got[n][1].split())
    with pytest.raises(ValueError):
        tx.chunks(F.col("t"), 10, 10)


def test_ngrams(spark):
    df = spark.createDataFrame([("CI/CD d'API x",), ("seul",), ("",)], "t string")
    got = [r[0] for r in df.select(tx.ngrams_1_2(tx.tokens(F.col("t")))).collect()]
    assert got == [["ci", "cd", "api", "ci cd", "cd api"], ["seul"], []]
