"""The n-gram join on Spark against all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import ngram_join as nj
from tests.llm.test_pure import folded

SCHEMA = "doc_id long, text string"


def brute(rows, words=4, percent=85):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", folded(text or ""))
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)}
        sets.append(grams if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and 100 * both >= percent * len(a | b):
                root[find(i)] = find(j)
    low: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted(
        ((r[0], len(sets[i]), low.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str
    )


def collected(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def texts(seed, n=260):
    """Chains of near copies at all distances, passages that many share, copies, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(40)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.choice([3, 4, 5, 8, 12, 40, 120]))]
        if rng.random() < 0.4:
            base = passage + base
        for _ in range(rng.choice([1, 1, 2, 6])):
            out.append(" ".join(base))
            for _ in range(rng.choice([0, 1, 1, 3])):
                base = list(base)
                base[rng.randrange(len(base))] = word()
                if rng.random() < 0.3:
                    base.insert(rng.randrange(len(base)), word())
    out += out[:25]
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(
    "how", [{}, {"run_rows": 2, "block_tokens": 150}, {"block_tokens": 40}]
)
def test_equals_all_pairs(spark, how, monkeypatch):
    if how:  # many small chunks and ranges, some of them dealt to several tasks
        monkeypatch.setattr(nj, "CHUNK_TOKENS", 400)
        monkeypatch.setattr(nj, "RANGE_TOKENS", 300)
    rows = texts(7)
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert collected(nj.jaccard_components(df, **how)) == want
    assert 100 < len({c for _, _, c in want}) < len(rows) - 40


def test_other_lengths_and_thresholds(spark):
    rows = texts(8, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = nj.jaccard_components(df, words=2, percent=60)
    assert collected(got) == brute(rows, 2, 60)


def test_large_group_in_small_blocks(spark):
    """Near copies of one text, each close to the original only, in many blocks."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        text = list(base)
        text[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(f"y{i}-{k}" for k in range(30))) for i in range(150, 170)]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = nj.jaccard_components(df, block_tokens=500, run_rows=8)
    assert collected(got) == want


def test_links_within_blocks_are_a_forest():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 30, 25).astype(np.uint64)) for _ in range(80)]
    links = nj.verified_links(sets, np.arange(80), 60)
    assert 10 < len(links) < 80
    for a, b in links:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 60 * (len(sets[a]) + len(sets[b]) - both)


def test_filters_keep_all_similar_pairs():
    """Similar sets share a prefix n-gram at places that both filters let pass."""
    rng = np.random.default_rng(1)
    n_similar = 0
    for _ in range(400):
        a = rng.choice(5000, rng.integers(1, 40), replace=False)
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.choice(5000, 2)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        n_similar += 1
        number = rng.integers(1, 4, 5000)
        number[np.intersect1d(a, b)] += 1
        sizes = np.array([len(a), len(b)])
        place, token = np.repeat([0, 1], sizes), np.concatenate([a, b])
        listed = number[token] > 1
        place, token = place[listed], token[listed]
        got, pos = nj.prefixes(place, token, number[token], sizes, 85)
        spots = [dict(zip(token[got][place[got] == i].tolist(), pos[place[got] == i].tolist())) for i in (0, 1)]
        met = [t for t in spots[0] if t in spots[1]]
        assert any(
            nj.may_link(len(a), np.array([spots[0][t]]), len(b), np.array([spots[1][t]]), 85)[0] for t in met
        )
    assert n_similar > 100


def test_packed_values():
    rng = np.random.default_rng(2)
    values = np.sort(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    assert np.array_equal(nj._unpack(nj._pack(values)), values)


def test_odd_rows(spark):
    long = "the quick brown fox jumps over a lazy dog again " * 4000
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "two words"), (7, "TWO\u000bwords"),
        (8, "two"), (9, long), (9, long), (None, long), (10, long + "extra"), (None, "no id here at all"),
        (11, "é è ê ë ü"), (12, "É è ê ë ü"), (None, None), (None, "alone without any name"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert collected(nj.jaccard_components(df)) == want
    wide = df
    for name in ("class", "n", "short", "root", "part", "block", "tokens", "low", "component_id"):
        wide = wide.withColumn(name, F.lit("x"))
    assert collected(nj.jaccard_components(wide)) == want
    assert nj.jaccard_components(df.where("false")).collect() == []
    assert collected(nj.jaccard_components(df.where("doc_id < 4"))) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
