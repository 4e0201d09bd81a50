"""Language-model scores from an Elias-Fano n-gram trie in shards.

The model is an interpolated bigram model with absolute discounting over word counts. A
shard of the trie holds contexts and their successors: pointers from each context to its
successors are a monotone sequence, and so are the successors of all contexts in turn, each
counted on from its context's place, so that one successor search relative to the context
finds a bigram. Probabilities and back-off weights are quantised logarithms. A shard's levels
are one flat buffer that is read in place.

Four steps. Words are counted by hash over all training texts, with partial sums before the
shuffle; what is sent out of that is a table of the words that have at least one in
``2 ** FREQUENT_BITS`` tokens, which bounds its size. The exact counts of the other words go
by a shuffle to the shards where they follow a context. Then all (context, word, document) triples go to the shard of their
context, once, packed, and repeats within a document as one; the shard counts those of
training documents, builds its trie and scores every triple. Last, the sums of each block of
documents are added up. A context with more than an eighth of a shard is split by its
successors; its total comes from the table. Its distinct successors are counted first in all
shards, from the same shuffled triples, and added up; every shard gets the sums.

Defined results: a null or empty text is the end token alone. Without training texts, counts
are 0 and all follows the formulas. Repeated rows each get a row and count as often as they
come. A null id is crc32 of an empty text and its score as any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .elias_fano import EliasFano
from .tables import stage_table

#: Words with at least this share (2 ** -20) of the tokens have an exact place in the table.
FREQUENT_BITS = 20
#: Words are counted in so many groups (2 ** 10), by the top bits of their hash.
BLOCK_BITS = 10
#: Training tokens of a shard, and tokens that a task packs at a time.
SHARD_TOKENS = 1_500_000
PACK_TOKENS = 1_000_000
#: Split contexts whose successors are added up in one group.
FAN_PART = 1024
DISCOUNT = 0.75
ALPHA = 0.1

START, END = np.uint64(1), np.uint64(2)
#: Quantised log10 values: steps of 1/5000 down to -13.
_STEPS = 5000.0

_ZSTD = pa.Codec("zstd")


def _pack(*arrays: np.ndarray) -> list[bytes]:
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        out.append(len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True))
    return out


def _unpack(cell, dtype) -> np.ndarray:
    size = int.from_bytes(cell[:8], "little")
    return np.frombuffer(_ZSTD.decompress(cell[8:], size), dtype=dtype)


def quantise(log: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log * _STEPS), 0, 65535).astype(np.uint16)


def unquantise(q: np.ndarray) -> np.ndarray:
    return q / -_STEPS


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, text) of every token, the end of each text included, and the number
    of tokens of each text."""
    words = bw.split_words(texts, bw.NOT_SPACE)
    n = words.counts()
    # Each text: start, its words, end.
    edge = words.bounds + 2 * np.arange(len(words.bounds))
    sequence = np.empty(int(edge[-1]), dtype=np.uint64)
    place = np.ones(len(sequence), dtype=bool)
    place[edge[:-1]] = place[edge[1:] - 1] = False
    sequence[place] = np.maximum(words.hashes(), np.uint64(3))
    sequence[edge[:-1]], sequence[edge[1:] - 1] = START, END
    doc = np.repeat(np.arange(len(n)), n + 2)
    token = np.ones(len(sequence), dtype=bool)
    token[edge[:-1]] = False
    at = np.flatnonzero(token)
    return sequence[at - 1], sequence[at], doc[at], n + 1


# --- counts of words --------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """Training tokens by block of their hash: ``block``, ``words``, ``counts`` (packed),
    ``n`` tokens and ``v`` distinct ones."""

    def blocks(parts):
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        edges = np.searchsorted(word >> np.uint64(64 - BLOCK_BITS), np.arange((1 << BLOCK_BITS) + 1))
        cells = [
            (b, *_pack(word[s:e], n[s:e].astype(np.int64)))
            for b, (s, e) in enumerate(zip(edges[:-1], edges[1:])) if e > s
        ]
        columns = list(zip(*cells))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1]), pa.array(columns[2])],
            names=["block", "words", "counts"],
        )

    def run(batches):
        parts, held = [], 0
        for batch in bw.slices(batches, "text"):
            parts.append(tokens_of(batch.column("text"))[1])
            held += len(parts[-1])
            if held >= 2 * PACK_TOKENS:
                yield blocks(parts)
                parts, held = [], 0
        if held:
            yield blocks(parts)

    def merge(table: pa.Table) -> pa.Table:
        word = np.concatenate([_unpack(c, np.uint64) for c in table.column("words").to_pylist()])
        n = np.concatenate([_unpack(c, np.int64) for c in table.column("counts").to_pylist()])
        word, at = np.unique(word, return_inverse=True)
        n = np.bincount(at, weights=n).astype(np.int64)
        cells = _pack(word, n)
        return pa.table({
            "block": table.column("block").slice(0, 1), "words": [cells[0]], "counts": [cells[1]],
            "n": pa.array([int(n.sum())]), "v": pa.array([len(word)]),
        })

    kind = "block int, words binary, counts binary"
    rows = docs.where("not held_out").select("text").mapInArrow(run, kind)
    return rows.groupBy("block").applyInArrow(merge, f"{kind}, n long, v long")


@dataclass
class Unigrams:
    """Counts of the training words that have at least ``least`` tokens."""

    n: int
    v: int
    documents: int
    least: int
    word: np.ndarray
    count: np.ndarray

    def frequent(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of ``word``, and whether they are in the table."""
        if not len(self.word):
            return np.zeros(len(word), np.int64), np.zeros(len(word), bool)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        ok = self.word[at] == word
        return np.where(ok, self.count[at], 0), ok

    def split(self, split_from: int) -> np.ndarray:
        """The contexts that are split by their successors, in order."""
        words = self.word[self.count >= split_from]
        # The start is a context of every document, and lower than any word.
        return np.append(START, words) if self.documents >= split_from else words

    def probability(self, word: np.ndarray, rare: np.ndarray, rare_count: np.ndarray) -> np.ndarray:
        """Of sorted words; ``rare``: those of them outside the table that were counted."""
        count, _ = self.frequent(word)
        count[np.searchsorted(word, rare)] = rare_count
        return (count + ALPHA) / (self.n + ALPHA * (self.v + 1))


def unigrams(counts: DataFrame) -> Unigrams:
    """The bounded table of ``counts``, which are those of all training words."""
    total = counts.agg(F.sum("n"), F.sum("v")).first()
    n, v = total[0] or 0, total[1] or 0
    least = max(1, -(-n >> FREQUENT_BITS))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                word = _unpack(batch.column("words")[row].as_py(), np.uint64)
                count = _unpack(batch.column("counts")[row].as_py(), np.int64)
                often = count >= least
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block").slice(row, 1),
                        *(pa.array(c) for c in zip(_pack(word[often], count[often]))),
                    ],
                    names=["block", "word", "count"],
                )

    rows = counts.select("block", "words", "counts").mapInArrow(run, "block int, word binary, count binary")
    words, often = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for row in sorted(rows.collect()):
        words.append(_unpack(bytes(row["word"]), np.uint64))
        often.append(_unpack(bytes(row["count"]), np.int64))
    return Unigrams(n, v, 0, least, np.concatenate(words), np.concatenate(often))


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return bw.mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _shard(model: Unigrams, shards: int, split_from: int, context: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The shard of each bigram: that of its context, or its own if the context is split."""
    count, _ = model.frequent(context)
    # The start is a context of every document.
    often = (count >= split_from) | ((context == START) & (model.documents >= split_from))
    return np.where(often, pair, bw.mix(context)) % np.uint64(shards)


def rare_counts(docs: DataFrame, counts: DataFrame, shared, shards: int) -> DataFrame:
    """Exact counts of the training words outside the table, for every shard where they follow
    a context: rows like those of ``_triples`` with block -1, words and, as codes, counts.

    Tasks ask for distinct (word, shard) pairs, by block of the word's hash.
    """
    split_from = SHARD_TOKENS // 8

    def blocks(parts):
        word, shard = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((shard, word))
        word, shard = word[order], shard[order]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (shard[1:] != shard[:-1])
        word, shard = word[new], shard[new]
        edges = np.searchsorted(word >> np.uint64(64 - BLOCK_BITS), np.arange((1 << BLOCK_BITS) + 1))
        cells = [
            (b, *_pack(word[s:e], shard[s:e])) for b, (s, e) in enumerate(zip(edges[:-1], edges[1:])) if e > s
        ]
        columns = list(zip(*cells)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            names=["block", "words", "shards"],
        )

    def run(batches):
        parts, held = [], 0
        for batch in bw.slices(batches, "text"):
            context, word, _, _ = tokens_of(batch.column("text"))
            rare = ~shared.value.frequent(word)[1]
            context, word = context[rare], word[rare]
            shard = _shard(shared.value, shards, split_from, context, _pair(context, word))
            parts.append((word, shard.astype(np.uint32)))
            held += len(rare)
            if held >= 2 * PACK_TOKENS:
                yield blocks(parts)
                parts, held = [], 0
        if held:
            yield blocks(parts)

    names = ["shard", "block", "docs", "words", "codes", "doc", "repeats"]
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 5

    def answer(table: pa.Table) -> pa.Table:
        words, asked, counted = (table.column(c).to_pylist() for c in ("words", "shards", "counts"))
        at = next((i for i, c in enumerate(counted) if c is not None), None)
        rows = []
        if at is not None and len(words) > 1:
            known, n = _unpack(words[at], np.uint64), _unpack(counted[at], np.int64)
            word = np.concatenate([_unpack(w, np.uint64) for w, s in zip(words, asked) if s is not None])
            shard = np.concatenate([_unpack(s, np.uint32) for s in asked if s is not None])
            place = np.minimum(np.searchsorted(known, word), len(known) - 1)
            met = known[place] == word
            key = np.unique(shard[met].astype(np.int64) * len(known) + place[met])
            place, shard = key % len(known), key // len(known)
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            rows = [
                (int(shard[s]), -1, b"", *_pack(known[place[s:e]], n[place[s:e]]), b"", b"")
                for s, e in zip(edges[:-1], edges[1:])
            ]
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    asks = docs.select("text").mapInArrow(run, "block int, words binary, shards binary")
    known = counts.select("block", "words", F.lit(None).cast("binary").alias("shards"), "counts")
    rows = asks.withColumn("counts", F.lit(None).cast("binary")).unionByName(known)
    return rows.groupBy("block").applyInArrow(answer, _TRIPLES)


# --- the trie ---------------------------------------------------------------------------


class Trie:
    """Contexts 0..c-1 and their successors 0..w-1, in compact levels."""

    def __init__(self, contexts: int, words: int, pointers: EliasFano, successors: EliasFano,
                 probability: np.ndarray, backoff: np.ndarray):
        self.contexts, self.words = contexts, words
        self.pointers, self.successors = pointers, successors
        self.probability, self.backoff = probability, backoff

    @classmethod
    def build(cls, key: np.ndarray, count: np.ndarray, total: np.ndarray, words: int,
              spread: np.ndarray, fan: np.ndarray | None = None) -> Trie:
        """``key``: sorted context * words + word of each bigram; ``total``: tokens that
        follow each context; ``spread``: in how many slices its successors are, each as
        large as this one; ``fan``: how many they are, where that is known."""
        contexts = len(total)
        context = key // words
        start = np.searchsorted(context, np.arange(contexts + 1))
        pointers = EliasFano.build(start.astype(np.uint64))
        fan = np.diff(start) * spread if fan is None else fan
        safe = np.maximum(total, 1)
        backoff = np.where(total > 0, np.minimum(DISCOUNT * fan / safe, 1.0), 1.0)
        backoff = np.where((total > 0) & (fan == 0), DISCOUNT, backoff)
        probability = np.maximum(count - DISCOUNT, 1e-13) / safe[context]
        return cls(
            contexts, words, pointers, EliasFano.build(key.astype(np.uint64)),
            quantise(np.log10(probability)), quantise(np.log10(np.maximum(backoff, 1e-13))),
        )

    def to_bytes(self) -> bytes:
        head = np.array([self.contexts, self.words, self.successors.n], np.uint64).tobytes()
        return (
            head + self.pointers.to_bytes() + self.successors.to_bytes()
            + self.probability.tobytes() + self.backoff.tobytes()
        )

    @classmethod
    def from_buffer(cls, buffer) -> Trie:
        """Read in place: ``buffer`` may be a mapped file."""
        contexts, words, n = (int(x) for x in np.frombuffer(buffer, np.uint64, 3))
        pointers, at = EliasFano.from_buffer(buffer, 24)
        successors, at = EliasFano.from_buffer(buffer, at)
        probability = np.frombuffer(buffer, np.uint16, n, at)
        backoff = np.frombuffer(buffer, np.uint16, contexts, at + 2 * n)
        return cls(contexts, words, pointers, successors, probability, backoff)

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of bigrams, and whether they are there.

        The successor search runs over all contexts at once, each word counted on from its
        context's own place, so it ends among the context's successors or beyond them.
        """
        at = self.successors.successor(context * self.words + word)
        end = self.pointers.get(context + 1).astype(np.int64)
        inside = at < end
        at = np.minimum(at, max(self.successors.n - 1, 0))
        if self.successors.n:
            inside &= self.successors.get(at) == (context * self.words + word).astype(np.uint64)
        return at, inside

    def score(self, context: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 probability of each bigram; ``lower``: probability of the word alone."""
        at, inside = self.find(context, word)
        own = np.zeros(len(context))
        own[inside] = 10.0 ** unquantise(self.probability[at[inside]])
        return np.log10(own + 10.0 ** unquantise(self.backoff[context]) * lower)


# --- scoring ----------------------------------------------------------------------------


_TRIPLES = "shard int, block long, docs binary, words binary, codes binary, doc binary, repeats binary"


def _triples(shared, shards: int):
    """Pack (context, word, document, repeats) by shard; documents by block of their own."""
    split_from = SHARD_TOKENS // 8
    def packed(block: int, context, word, doc, train, docs):
        pair = _pair(context, word)
        order = np.argsort(pair, kind="stable")
        context, word, doc, pair = context[order], word[order], doc[order], pair[order]
        new = np.ones(len(pair), dtype=bool)
        new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        repeats = np.diff(np.append(at, len(pair)))
        context, word, doc, pair = context[at], word[at], doc[at], pair[at]
        shard = _shard(shared.value, shards, split_from, context, pair)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
        rows = [(-1 - block % 4096, block, docs, b"", b"", b"", b"")]
        for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b > a:
                own = order[a:b]
                words, codes = np.unique(
                    np.concatenate([context[own], word[own]]), return_inverse=True
                )
                codes = codes.astype(np.uint32)
                rows.append((
                    s, block, b"",
                    *_pack(words, codes, (doc[own] * 2 + train[doc[own]]).astype(np.uint32),
                           repeats[own].astype(np.uint32)),
                ))
        columns = list(zip(*rows))
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["shard", "block", "docs", "words", "codes", "doc", "repeats"],
        )

    def table_bytes(batches) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batches[0].schema) as out:
            for b in batches:
                out.write_batch(b)
        return sink.getvalue().to_pybytes()

    def run(batches):
        base, serial = TaskContext.get().partitionId() << 32, 0
        held: list = []
        docs: list = []
        n_docs = n_tokens = 0

        def flush():
            context, word, doc = (np.concatenate(x) for x in zip(*held))
            info = table_bytes(docs)
            train = np.concatenate([~d.column(1).to_numpy(zero_copy_only=False) for d in docs])
            return packed(base + serial, context, word, doc, train, info)

        for batch in bw.slices(batches, "text"):
            context, word, doc, n = tokens_of(batch.column("text"))
            held.append((context, word, doc + n_docs))
            docs.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(n)],
                names=["doc_id", "held_out", "n_tokens"],
            ))
            n_docs, n_tokens = n_docs + batch.num_rows, n_tokens + len(word)
            if n_tokens >= PACK_TOKENS:
                yield flush()
                serial += 1
                held, docs, n_docs, n_tokens = [], [], 0, 0
        if docs:
            yield flush()

    return run


_FANS = "part int, fans binary"


def _split_successors(shared):
    """Distinct training successors of the split contexts in a shard, by parts of these."""
    split_from, per = SHARD_TOKENS // 8, FAN_PART

    def run(table: pa.Table) -> pa.Table:
        contexts = shared.value.split(split_from)
        columns = [table.column(c).to_pylist() for c in ("shard", "block", "words", "codes", "doc")]
        pairs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for shard, block, w, codes, d in zip(*columns):
            if shard < 0 or block < 0:
                continue
            words, codes = _unpack(w, np.uint64), _unpack(codes, np.uint32)
            place = np.minimum(np.searchsorted(contexts, words), len(contexts) - 1)
            split = contexts[place] == words
            half = len(codes) // 2
            own = split[codes[:half]] & ((_unpack(d, np.uint32) & 1) == 1)
            context, word = codes[:half][own], codes[half:][own]
            pairs.append(_pair(words[context], words[word]))
            places.append(place[context])
        # A pair is known by 64 bits, as is a word.
        _, first = np.unique(np.concatenate(pairs), return_index=True)
        fans = np.bincount(np.concatenate(places)[first], minlength=len(contexts))
        parts = [(k, *_pack(fans[a : a + per])) for k, a in enumerate(range(0, len(fans), per)) if fans[a : a + per].any()]
        part, packed = zip(*parts) if parts else ((), ())
        return pa.table({"part": pa.array(part, pa.int32()), "fans": pa.array(packed, pa.binary())})

    return run


def _add_fans(table: pa.Table) -> pa.Table:
    fans = sum(_unpack(c, np.int64) for c in table.column("fans").to_pylist())
    return pa.table({"part": table.column("part").slice(0, 1), "fans": _pack(fans)})


def _score_shard(shared):
    """Of a shard's triples, and of the successors of the split contexts in all shards."""
    split_from, per = SHARD_TOKENS // 8, FAN_PART
    names = ["block", "docs", "base", "score", "known"]

    def run(table: pa.Table, parts: pa.Table | None) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], k) for k in [pa.int64()] + [pa.binary()] * 4], names=names)
        if table.column("shard")[0].as_py() < 0:
            empty = pa.array([b""] * table.num_rows, pa.binary())
            return pa.table([table.column("block"), table.column("docs"), *[empty] * 3], names=names)
        model = shared.value
        counted = [
            (_unpack(w, np.uint64), _unpack(n, np.int64))
            for b, w, n in zip(*(table.column(c).to_pylist() for c in ("block", "words", "codes"))) if b < 0
        ]
        rare, rare_count = (np.concatenate(x) for x in zip((np.zeros(0, np.uint64), np.zeros(0, np.int64)), *counted))
        table = table.filter(pc.greater_equal(table.column("block"), 0))
        cells = {c: table.column(c).to_pylist() for c in ("block", "words", "codes", "doc", "repeats")}
        own_words = [_unpack(c, np.uint64) for c in cells["words"]]
        words = np.unique(np.concatenate(own_words))
        context, word, doc, train, repeats, sizes = [], [], [], [], [], []
        first = 0
        for w, codes, d, r in zip(own_words, cells["codes"], cells["doc"], cells["repeats"]):
            code = np.searchsorted(words, w)[_unpack(codes, np.uint32)]
            half = len(code) // 2
            d = _unpack(d, np.uint32).astype(np.int64)
            context.append(code[:half]), word.append(code[half:])
            doc.append((d >> 1) + first), train.append((d & 1).astype(bool))
            repeats.append(_unpack(r, np.uint32))
            sizes.append(int((d >> 1).max()) + 1)
            first += sizes[-1]
        context, word, doc = np.concatenate(context), np.concatenate(word), np.concatenate(doc)
        train, repeats = np.concatenate(train), np.concatenate(repeats).astype(np.float64)

        key = context * len(words) + word
        pairs, at = np.unique(key, return_inverse=True)
        seen = np.bincount(at[train], weights=repeats[train], minlength=len(pairs))
        total = np.bincount(context[train], weights=repeats[train], minlength=len(words))
        known = seen > 0
        fan = np.bincount(pairs[known] // len(words), minlength=len(words))
        contexts = model.split(split_from)
        if len(contexts):
            fans = np.zeros(len(contexts), np.int64)
            for part, packed in zip(*(parts.column(c).to_pylist() for c in ("part", "fans"))):
                own = _unpack(packed, np.int64)
                fans[part * per : part * per + len(own)] = own
            place = np.minimum(np.searchsorted(contexts, words), len(contexts) - 1)
            split = contexts[place] == words
            count, _ = model.frequent(words)
            total = np.where(split, np.where(words == START, model.documents, count), total)
            fan = np.where(split, fans[place], fan)
        trie = Trie.build(pairs[known], seen[known], total, len(words), np.ones(len(words)), fan)
        trie = Trie.from_buffer(trie.to_bytes())
        lower = model.probability(words, rare, rare_count)
        log = trie.score(pairs // len(words), pairs % len(words), lower[pairs % len(words)])
        score = np.bincount(doc, weights=log[at] * repeats, minlength=first)
        # Each word is the context of exactly one token, so its own count is here.
        real = words[context] != START
        base = np.bincount(
            doc[real], weights=(np.log10(total + ALPHA)[context] * repeats)[real], minlength=first
        )
        n_known = np.bincount(
            doc[real], weights=((total > 0)[context] * repeats)[real], minlength=first
        )
        edges = np.cumsum([0, *sizes])
        rows = [
            (block, b"", *_pack(base[a:b], score[a:b].astype(np.float32), n_known[a:b].astype(np.uint32)))
            for block, a, b in zip(cells["block"], edges[:-1], edges[1:])
        ]
        kinds = [pa.int64()] + [pa.binary()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def _add_up(shared):
    def run(table: pa.Table) -> pa.Table:
        model = shared.value
        cells = table.to_pydict()
        docs = pa.ipc.open_stream(next(d for d in cells["docs"] if d)).read_all()
        n = docs.num_rows
        base, score, known = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
        for b, s, k in zip(cells["base"], cells["score"], cells["known"]):
            if b:
                b = _unpack(b, np.float64)
                base[: len(b)] += b
                score[: len(b)] += _unpack(s, np.float32)
                known[: len(b)] += _unpack(k, np.uint32)
        tokens = docs.column("n_tokens").to_numpy().astype(np.int64)
        base += np.log10(model.documents + ALPHA)
        base -= tokens * np.log10(model.n + ALPHA * (model.v + 1))
        known += model.documents > 0
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(tokens), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(n, model.n, dtype=np.int64)),
            "base_score": pa.array(base), "score": pa.array(score),
        })

    return run


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def lm_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of those not held out."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = stage_table(word_counts(rows), "word_counts")
    model = unigrams(counts)
    model.documents = rows.where("not held_out").count()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shards = max(1, -(-model.n // SHARD_TOKENS))
    triples = rows.mapInArrow(_triples(shared, shards), _TRIPLES)
    if model.least > 1:  # else all words are in the table
        triples = triples.unionByName(rare_counts(rows, counts, shared, shards))
    by_shard, sums = triples.groupBy("shard"), "block long, docs binary, base binary, score binary, known binary"
    if len(model.split(SHARD_TOKENS // 8)):
        # Both passes over the triples read the same shuffle.
        fans = by_shard.applyInArrow(_split_successors(shared), _FANS).groupBy("part").applyInArrow(_add_fans, _FANS)
        every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        sums = by_shard.cogroup(fans.select(every, "part", "fans").groupBy("shard")).applyInArrow(
            _score_shard(shared), sums
        )
    else:
        score = _score_shard(shared)
        sums = by_shard.applyInArrow(lambda table: score(table, None), sums)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return sums.groupBy("block").applyInArrow(
        _add_up(shared),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
