import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import tandem.operators.dense as dn
import tandem.operators.retrieval as rt
from tandem.functions import text as tx

DOCS = [
    (0, "Cloud", "docker kubernetes terraform et supervision"),
    (1, "Données", "python sql airflow, entrepôts de données"),
    (2, "Serveur", "python fastapi postgresql et pytest"),
    (3, "Vitrine", "react typescript accessibilité"),
    (4, "Modèles", "pytorch fastapi supervision de dérive"),
    (5, "Vitrine", "react typescript accessibilité"),
]
QUERIES = [(0, "docker terraform"), (1, "python"), (2, "react typescript"), (3, "inconnu zzz"), (4, "supervision python python")]


def brute(k):
    import re

    toks = lambda t: re.findall(r"\w\w+", t.lower())
    corpus = {i: Counter(toks(f"{a}. {b}")) for i, a, b in DOCS}
    df = Counter(t for c in corpus.values() for t in c)
    idf = {t: math.log((1 + len(DOCS)) / (1 + d)) + 1 for t, d in df.items()}

    def unit(c):
        w = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()} if norm else {}

    vecs = {i: unit(c) for i, c in corpus.items()}
    out = {}
    for q, text in QUERIES:
        v = unit(Counter(toks(text)))
        s = [(-round(sum(x * vecs[i].get(t, 0.0) for t, x in v.items()), 9), i) for i in vecs]
        out[q] = [(i, -x) for x, i in sorted(s)[:k]]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return rt.corpus(spark.createDataFrame(DOCS, "doc_id long, title string, body string"), "title", "body")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id int, query string")


def as_dict(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 9)))
    return out


def test_unit_norms(docs):
    w = rt.build_index(docs).postings.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in w.collect())


@pytest.mark.parametrize("k", [1, 4, 9])
def test_topk_equals_brute_force(docs, queries, k):
    got = as_dict(rt.retrieve(rt.build_index(docs), queries, k))
    want = brute(k)
    assert got == {q: [(i, pytest.approx(s, abs=1e-8)) for i, s in v] for q, v in want.items()}
    assert all(len(v) == min(k, len(DOCS)) for v in got.values())


def test_shuffled_path_gives_the_same(docs, queries, monkeypatch):
    want = as_dict(rt.retrieve(rt.build_index(docs), queries, 4))
    monkeypatch.setattr(rt, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr("tandem.plans.skew.fits_broadcast", lambda *a: False)
    assert as_dict(rt.retrieve(rt.build_index(docs), queries, 4)) == want


def test_index_round_trip(spark, docs, queries, tmp_path):
    index = rt.build_index(docs)
    index.write(str(tmp_path / "ix"))
    back = rt.LexicalIndex.read(spark, str(tmp_path / "ix"), "doc_id")
    assert as_dict(rt.retrieve(back, queries, 2)) == as_dict(rt.retrieve(index, queries, 2))


def test_recall_and_prompt(spark, docs, queries):
    ranked = rt.retrieve(rt.build_index(docs), queries, 3)
    gold = spark.createDataFrame([(0, 0), (1, 2), (2, 5), (3, 5)], "query_id int, expected long")
    got = {r.k: r.recall for r in rt.recall_at_k(ranked, gold, (1, 2, 3)).collect()}
    top = brute(3)
    for k in (1, 2, 3):
        hits = sum(e in [i for i, _ in top[q][:k]] for q, e in [(0, 0), (1, 2), (2, 5), (3, 5)])
        assert got[k] == pytest.approx(hits / 4)
    p = rt.prompts(ranked.where("rank <= 2"), docs, queries).where("query_id = 0").first().prompt
    assert "[1] (0) Cloud — Cloud. docker" in p and "[2]" in p and "UNIQUEMENT" in p
    assert p.endswith("PROFIL RECHERCHÉ (anonymisé) : docker terraform\n")
    assert "dis-le explicitement" in p


def test_dense_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(60, 8)), rng.normal(size=(9, 8))
    q[3] = 0
    vec = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id int, embedding array<double>")
    x32 = np.array(x, dtype="float32").astype("float64")
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    s = np.round(unit(q) @ unit(x32).T, 9)
    want = {i: [int(j) for j in np.lexsort((np.arange(60), -s[i]))[:4]] for i in range(9)}
    for block, clusters in ((512, 64), (2, 3), (512, 1)):
        monkeypatch.setattr(dn, "QUERY_BLOCK", block)
        monkeypatch.setattr(dn, "HELD", 10 * block)
        rows = dn.dense_topk(vec, qs, 4, clusters=clusters).orderBy("query_id", "rank").collect()
        got = {}
        for r in rows:
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == want
    assert dn.dense_topk(vec.where("false"), qs, 4).collect() == []
    assert dn.dense_topk(vec, qs.where("false"), 4).columns == ["query_id", "vec_id", "score", "rank"]


def test_dense_skips_far_clusters(spark):
    """Clustered vectors with copies: most clusters are never read, and no neighbour is lost."""
    rng = np.random.default_rng(6)
    heads = rng.normal(size=(30, 16))
    x = np.repeat(heads, 40, axis=0) + 0.05 * rng.normal(size=(1200, 16))
    x[5:25] = x[4]
    q = x[::60] + 0.01 * rng.normal(size=(20, 16))
    vec = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    vec = vec.unionByName(spark.createDataFrame([(9999, None)], vec.schema))
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, embedding array<double>")
    s = np.round(dn.unit(q) @ dn.unit(x).T, 9)
    want = {(i, int(j), r) for i in range(20) for r, j in enumerate(np.lexsort((np.arange(1200), -s[i]))[:10], 1)}
    rows = dn.dense_topk(vec, qs, 10, clusters=30).collect()
    assert {(r.query_id, r.vec_id, r["rank"]) for r in rows} == want
    left_out = dn.skipped(vec, qs, 10, clusters=30).collect()
    share = sum(r.vectors_skipped for r in left_out) / sum(r.n_vectors for r in left_out)
    assert len(left_out) == 20 and share > 0.5


def test_idf_formula(docs):
    r = {x.term: x.idf for x in rt.idf_table(docs).collect()}
    assert r["docker"] == pytest.approx(math.log(7 / 2) + 1)
    assert r["python"] == pytest.approx(math.log(7 / 3) + 1)


def test_token_classes(spark):
    df = spark.createDataFrame([("L'Été à_b C++ x1 é",)], "t string")
    assert df.select(tx.tokens(F.col("t"))).first()[0] == ["été", "à_b", "x1"]


def test_frequent_terms_stay_and_rare_ones_move(docs, queries, monkeypatch):
    from tandem.plans import skew

    want = sorted(map(tuple, rt.build_index(docs, "doc_id", "text").postings.collect()))
    # Only the idf of all terms is too large; that of the most frequent three is not.
    small = lambda t, *a: "idf" not in t.columns or t.count() <= 3
    monkeypatch.setattr(rt, "fits_broadcast", small)
    monkeypatch.setattr(skew, "fits_broadcast", small)
    monkeypatch.setattr(skew, "FREQUENT_KEYS", 3)
    met = []
    monkeypatch.setattr(skew, "salted_join", lambda *a: met.append(a))
    got = sorted(map(tuple, rt.build_index(docs, "doc_id", "text").postings.collect()))
    assert not met and len(got) == len(want) > 3
    for (d, t, n, w), (d2, t2, n2, w2) in zip(got, want):
        assert (d, t, n) == (d2, t2, n2) and abs(w - w2) < 1e-12


def test_frequent_lookup_drops_and_keeps_as_a_join(spark, monkeypatch):
    from tandem.plans import skew

    rows = spark.createDataFrame([(i, k) for i, k in enumerate("aaaabbbcdd") ] + [(98, None), (99, "z")], "i int, k string")
    table = spark.createDataFrame([("a", 4, 1), ("b", 3, 2), ("c", 1, 3), ("d", 2, 4), ("e", 0, 5)], "k string, n int, v int")
    want = sorted(map(tuple, rows.join(table, "k").collect()))
    monkeypatch.setattr(skew, "fits_broadcast", lambda t, *a: t.count() <= 2)
    monkeypatch.setattr(skew, "FREQUENT_KEYS", 2)
    assert sorted(map(tuple, skew.frequent_lookup(rows, table, "k", F.col("i"), "n").collect())) == want
