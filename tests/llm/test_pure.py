"""Parts without Spark against plain Python: words, bits, tries, tokens, packing, forests."""

from __future__ import annotations

import mmap
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tandem.llm import bpe, bytewords, langid, packing, quality, simhash, url_filter
from tandem.llm.elias_fano import EliasFano
from tandem.llm.ngram_lm import Trie
from tandem.llm.queries import tokenizer_path

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60)), min_size=1, max_size=6)
PATTERNS = (
    (bytewords.NOT_SPACE, r"[^\x20\x09-\x0D]+"),
    (bytewords.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
)


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for table, pattern in PATTERNS:
        words = bytewords.split_words(pa.array(texts, pa.string()), table)
        for t, text in enumerate(texts):
            a, b = words.bounds[t], words.bounds[t + 1]
            want = re.findall(pattern, folded(text))
            assert [words.join(i, i + 1) for i in range(a, b)] == want


def test_word_hashes_and_shingles_tell_words_apart():
    words = bytewords.split_words(pa.array(["a b c a b c", "b c"]), bytewords.NOT_SPACE)
    h = words.hashes()
    assert len(set(h.tolist())) == 3
    two = bytewords.shingles(h, 2)
    ok = bytewords.inside(words.bounds, 2, len(two))
    assert two[0] == two[3] and two[1] == two[4] == two[6]
    assert ok.tolist() == [True, True, True, True, True, False, True]


# --- SimHash ------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def test_fingerprints_match_the_definition():
    texts = [None, "", " \n", "One", "a B c", "a b c d", "a b c d e\tf  g", "é ü ñ 漢字 x " * 9]
    got = simhash.fingerprint_texts(pa.array(texts))
    assert got.tolist() == [brute_fingerprint(t) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 4))
def test_parts_and_thresholds_lose_no_pair(seed, flips):
    rng = np.random.default_rng(seed)
    sample = rng.integers(0, 2**63, 200, dtype=np.uint64)
    for n in (200, 10**6, 10**9):
        parts = simhash.plan(sample, n)
        assert sum(t + 1 for _, t in parts) == simhash.MAX_BITS + 1
        bits = [b for group, _ in parts for b in group]
        assert len(bits) == len(set(bits))
        x = int(sample[0])
        y = x
        for b in rng.choice(64, flips, replace=False):
            y ^= 1 << int(b)
        apart = [sum((x ^ y) >> b & 1 for b in group) for group, _ in parts]
        assert any(d <= t for d, (_, t) in zip(apart, parts))


def test_spanning_links_connect_as_all_pairs_do():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.array([b ^ (np.uint64(1) << np.uint64(k)) for b in base for k in range(20)])
    a, b = simhash.spanning_links(fps, 4)
    assert len(a) == len(fps) - 5
    assert all((int(x) ^ int(y)).bit_count() <= 4 for x, y in zip(a, b))


# --- Elias-Fano and the trie --------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=60), st.lists(st.integers(0, 10**12 + 9), max_size=20))
def test_sequence_round_trip_and_successor(values, queries):
    values = sorted(values)
    made = EliasFano.build(np.array(values, dtype=np.uint64))
    seq, end = EliasFano.from_buffer(made.to_bytes())
    assert end == len(made.to_bytes())
    assert seq.get(np.arange(len(values))).tolist() == values
    got = seq.successor(np.array(queries + values, dtype=np.uint64)).tolist()
    assert got == [sum(v < q for v in values) for q in queries + values]


def test_trie_reads_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(3)
    pairs = np.unique(rng.integers(0, 50 * 50, 400))
    count = rng.integers(1, 9, len(pairs))
    total = np.bincount(pairs // 50, weights=count, minlength=50)
    trie = Trie.build(pairs, count, total, 50, np.ones(50))
    path = tmp_path / "trie"
    path.write_bytes(trie.to_bytes())
    with path.open("rb") as file:
        trie = Trie.from_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        every = np.arange(2500)
        lower = np.full(2500, 1 / 50)
        got = trie.score(every // 50, every % 50, lower)
        known = dict(zip(pairs.tolist(), count.tolist()))
        fan = Counter((pairs // 50).tolist())
        for key in range(2500):
            t, c = total[key // 50], known.get(key, 0)
            want = (max(c - 0.75, 0) + 0.75 * fan[key // 50] / 50) / t if t else 1 / 50
            assert got[key] == pytest.approx(np.log10(want), abs=3e-4)
        # The probabilities of a context's words add up to one.
        assert (10.0**got).reshape(50, 50).sum(axis=1) == pytest.approx(np.ones(50), abs=1e-3)


# --- tokens and packing -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path()) if not hasattr(test_ids_are_those_of_the_library, "t") else test_ids_are_those_of_the_library.t
    test_ids_are_those_of_the_library.t = library
    encoder = bpe.encoder(tokenizer_path())
    want = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text).tolist() == want
    # Cut as a long text is.
    parts = bpe.chunks(text, 20, 2)
    assert sum(encoder.count_between(*p) for p in parts) == len(want)


@pytest.mark.parametrize(
    "text",
    [
        "", "a" * 3000, " " * 3000 + "z", "x<|endoftext|> y<|endoftext|>12 it's  \n\n " * 200,
        "漢字漢字。" * 500, "ab12cd34," * 500, "it'll we've " * 400, "漢" * 2000,
    ],
)
def test_long_texts_splice(library, text):
    encoder = bpe.encoder(tokenizer_path())
    want = library.encode(text, add_special_tokens=False).ids
    for size, overlap in ((100, 4), (500, 64)):
        assert sum(encoder.count_between(*p) for p in bpe.chunks(text, size, overlap)) == len(want)
    assert encoder.ids(text).tolist() == want


def test_another_kind_of_tokenizer_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Encoder(str(public_tokenizers.path("word_bpe_49k.json")))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 2047), min_size=1, max_size=120))
def test_packing_is_whole_and_never_overfull(sizes):
    sizes = np.array(sizes)
    items, at = packing.pack(sizes)
    loads, seen = Counter(), Counter()
    for (i, start, length), w in zip(items, at.tolist()):
        assert start == seen[i]
        loads[w] += length
        seen[i] += length
    assert max(loads.values()) <= packing.WINDOW
    assert [seen[i] for i in range(len(sizes))] == sizes.tolist()


def test_differencing_is_nearly_even():
    sizes = np.random.default_rng(0).integers(1, 400, 600)
    at, loads = packing.difference(sizes, 40)
    assert np.bincount(at, weights=sizes, minlength=40).astype(int).tolist().sort() == loads.tolist().sort()
    assert loads.max() - loads.min() <= 0.01 * loads.mean()


# --- rules, languages, hosts --------------------------------------------------------------


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)})


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \n\t#$|é", max_size=60))
def test_rule_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    got = dict(zip(quality.COUNTS, quality.rule_counts(text)))
    assert got == {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": brute_repeats(words),
    }


def test_forest_isolates_what_is_unlike_the_rest():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (400, 3)), rng.normal(9, 0.1, (8, 3))])
    good = np.arange(408) < 400
    scores = quality.grow(x, good, quality.ForestSize(50, 128)).scores(x)
    assert scores[400:].min() > np.quantile(scores[:400], 0.98)
    assert quality.calibrate(np.zeros((2, quality.BINS + 1)), 0.01) == np.inf


def test_few_centroids_tell_languages():
    texts = {"aa": "lorem ipsum dolor", "bb": "zwölf boxkämpfer jagen"}
    rows = [(k, " ".join(v.split()[i % 3 :] * 4)) for k, v in texts.items() for i in range(6)]
    counts = langid.trigram_counts(pa.array([t for _, t in rows]))
    idf = np.ones(langid.DIMS, dtype=np.float32)
    made = [langid.cluster(langid.vectors(counts[i : i + 6], idf), 2) for i in (0, 6)]
    model = langid.Centroids(
        ["aa"] * len(made[0][0]) + ["bb"] * len(made[1][0]), idf,
        np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]),
    )
    langs, score, far = model.nearest(pa.array(["ipsum dolor lorem", "jagen zwölf", None, "12 !"]))
    assert langs == ["aa", "bb", "und", "und"]
    assert score[2] == score[3] == 0 and far[2] and far[3]


def test_labels_split_into_words():
    counts = {"free": 50, "bets": 30, "casino": 20, "win": 40, "a": 5}
    assert url_filter.segment("freebets", counts, 145) == ["free", "bets"]
    assert url_filter.segment("casinowin", counts, 145) == ["casino", "win"]
    assert "".join(url_filter.segment("xqzfreeyy", counts, 145)) == "xqzfreeyy"
    assert url_filter.segment("", counts, 145) == []


def test_piece_checksums_are_those_of_little_endian_ids():
    ids = np.array([1, 50256, 7], dtype="<u4")
    assert zlib.crc32(ids.tobytes()) == zlib.crc32(b"\1\0\0\0\x50\xc4\0\0\7\0\0\0")
