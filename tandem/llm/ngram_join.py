"""N-gram Jaccard join by rare-first prefixes, and its components.

A document's set has a 64-bit hash of each distinct run of ``WORDS`` words. Documents with
equal sets are one class, named by a 128-bit digest, and only classes are joined. All sets
share one order of their n-grams, by their number in the corpus and then by hash, rare
ones first. Two sets of a Jaccard similarity of ``percent``
hundredths share an n-gram within their prefixes, the first n - ceil(percent n) + 1 of each.

1. Counts of all n-grams are gathered by ranges of their hashes, as packed sorted runs that
   each task makes of a chunk of its documents. The n-grams themselves, with the place of
   their document in the chunk, then meet the counts of their range, and those that occur
   more than once go back to their chunk. N-grams that occur once come first in every set
   and meet nobody, so a document that has enough of them is done.
2. The prefixes' n-grams meet. Within an n-gram, classes that pass the length and positional
   filters are linked by a spanning forest, so a group of m gives m - 1 links at most. An
   n-gram of more than ``RUN_ROWS`` classes is dealt by size and linked to one class of its
   size or the next, by aggregation alone.
3. Sets of linked classes are made again from the texts and meet in the component that these
   links make, each pair of classes once: pairs of other lengths are left out, a lower bound
   of the difference by the sizes of hash parts (the suffix filter) drops most of the others,
   and the rest is counted exactly. Pairs that are connected already are not looked at. A
   component beyond ``BLOCK_TOKENS`` is cut into blocks that share some of its classes;
   what this leaves unconnected is compared with all of the component, block by block.

Defined results: a null text and one without words have an empty set, linked with nothing.
Fewer words than ``WORDS`` are one n-gram. Repeated rows each get a row. A row without
``doc_id`` gets the component's least id, or null if there is none; an empty set's component
is its own id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, lookup, salted_join
from . import bytewords as bw
from .components import components
from .tables import stage_table

WORDS = 4
PERCENT = 85
#: Classes of one n-gram that are linked in one group.
RUN_ROWS = 16_384
#: N-grams of sets that are compared in one group.
BLOCK_TOKENS = 4 << 20
#: Classes that all blocks of a component share.
SHARED = 16
#: Parts of the suffix filter.
PARTS = 32
#: N-grams in one range of hashes, and in one chunk of documents, about.
RANGE_TOKENS, CHUNK_TOKENS = 8 << 20, 4 << 20
#: Most bits of the filter of linked classes; beyond it more sets are made in vain.
FILTER_BITS = 1 << 27

#: Bits by which n-grams are counted and ordered; the count is cut at that of two bytes.
_BITS, _MOST = 40, 65_535


def needed(n, percent: int):
    """Least overlap of a set of n with any set that it links with."""
    return -(-percent * n // 100)


def pair_overlap(n, m, percent: int):
    """Least overlap of two sets of n and m that link."""
    return -(-percent * (n + m) // (100 + percent))


# --- sets of documents --------------------------------------------------------------------


def text_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams."""
    w = bw.split_words(texts, bw.NOT_SPACE)
    h = w.hashes()
    runs = bw.shingles(h, words)
    out = []
    for s, e in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if e - s >= words:
            out.append(np.unique(runs[s : e - words + 1]))
        else:
            out.append(bw.shingles(h[s:e], e - s) if e > s else h[:0])
    return out


def _named(batches, words: int):
    """Slices of the texts with (row, set, digest) of each that has an n-gram."""
    for batch in bw.slices(batches, "text"):
        sets = text_sets(batch.column("text"), words)
        yield batch, [(s, xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None) for s in sets]


def _distinct(batches, words: int):
    """The sets of a task's texts, equal ones once, as (digest, set)."""
    seen = set()
    for _, sets in _named(batches, words):
        new = []
        for s, digest in sets:
            if digest is not None and digest not in seen:
                seen.add(digest)
                new.append((digest, s))
        if new:
            yield new


def _short(digests) -> np.ndarray:
    """The part of the digests by which candidates are found; two may share it."""
    return np.frombuffer(b"".join(d[:8] for d in digests), "<i8")


def _classes(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, class (hex digest, null for an empty set) and size of each row's set."""

    def run(batches):
        for batch, sets in _named(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([d and d.hex() for _, d in sets], pa.string()),
                    pa.array([len(s) for s, _ in sets], pa.int64()),
                ],
                names=["doc_id", "class", "n"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, class string, n long")


# --- counts of n-grams --------------------------------------------------------------------


def _pack(sorted_values: np.ndarray) -> bytes:
    """Steps between sorted 40-bit values in byte planes, the high ones mostly zero."""
    steps = np.diff(sorted_values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(5, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :5] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _planes(values: np.ndarray, kind: str) -> bytes:
    wide = np.ascontiguousarray(values.astype(kind)).view(np.uint8)
    wide = wide.reshape(len(values), np.dtype(kind).itemsize)
    return np.ascontiguousarray(wide.T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _chunks(batches, words: int, ranges: int):
    """Chunks of a task's distinct sets."""
    held, size = [], 0
    for new in _distinct(batches, words):
        held += new
        size += sum(len(s) for _, s in new)
        if size >= max(CHUNK_TOKENS, 16 * ranges):
            yield held
            held, size = [], 0
    if held:
        yield held


def _by_range(values: np.ndarray, ranges: int) -> list[tuple[int, slice]]:
    """The stretch of sorted values in each range of the hashes."""
    at = (values // np.uint64(-(-(1 << _BITS) // ranges))).astype(np.int64)
    edge = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(at)]])
    return [(int(at[s]), slice(s, e)) for s, e in zip(edge[:-1], edge[1:])]


def _short_tokens(sets: list) -> np.ndarray:
    return np.concatenate([s for _, s in sets]) >> np.uint64(64 - _BITS)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted values start."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])


def _counts(texts: DataFrame, words: int, ranges: int) -> DataFrame:
    """By range: the n-grams that occur twice or more and their numbers, packed; ``size`` is
    how many places the range has in all."""

    def gather(batches):
        for sets in _chunks(batches, words, ranges):
            values = np.sort(_short_tokens(sets))
            first = _runs(values)
            n = np.minimum(np.diff(np.append(first, len(values))), _MOST)
            values = values[first]
            rows = [(r, _pack(values[p]), _planes(n[p], "<u2")) for r, p in _by_range(values, ranges)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["range", "data", "n"],
            )

    def count(group: pa.Table) -> pa.Table:
        values = np.concatenate([_unpack(d) for d in group.column("data").to_pylist()])
        n = np.concatenate([_from_planes(d, "<u2") for d in group.column("n").to_pylist()])
        order = np.argsort(values, kind="stable")
        values, n = values[order], n[order].astype(np.int64)
        first = _runs(values)
        n = np.add.reduceat(n, first)
        many = n > 1
        return pa.table(
            {
                "range": group.column("range").slice(0, 1), "size": [int(n.sum())],
                "data": pa.array([_pack(values[first[many]])], pa.binary()),
                "n": pa.array([_planes(np.minimum(n[many], _MOST), "<u2")], pa.binary()),
            }
        )

    rows = texts.mapInArrow(gather, "range long, data binary, n binary")
    return rows.groupBy("range").applyInArrow(count, "range long, size long, data binary, n binary")


_PLACES = "range long, chunk long, data binary, at binary"


def _places(texts: DataFrame, words: int, ranges: int) -> DataFrame:
    """By chunk and range: sorted n-grams and the places of their documents in the chunk.
    Range -1 has the chunk's list of documents, their short digests and sizes."""

    def run(batches):
        task = TaskContext.get().partitionId()
        for number, sets in enumerate(_chunks(batches, words, ranges)):
            values = _short_tokens(sets)
            sizes = np.array([len(s) for _, s in sets])
            order = np.argsort(values, kind="stable")
            values, at = values[order], np.repeat(np.arange(len(sets)), sizes)[order]
            short = _short([d for d, _ in sets])
            rows = [(-1, short.tobytes(), sizes.astype("<i8").tobytes())]
            rows += [(r, _pack(values[p]), _planes(at[p], "<u4")) for r, p in _by_range(values, ranges)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array([(task << 24) + number] * len(rows), pa.int64()),
                    *[pa.array(c, pa.binary()) for c in columns[1:]],
                ],
                names=["range", "chunk", "data", "at"],
            )

    return texts.mapInArrow(run, _PLACES)


_KNOWN = "chunk long, range long, data binary, at binary, n binary"


def _known(places: DataFrame, counts: DataFrame) -> DataFrame:
    """What occurs more than once of each chunk's n-grams, with its number.

    The counts of a range come first, then its chunks one by one, so a task holds the counts
    of one range. A range with many places, as a frequent n-gram makes, is dealt to several.
    """

    def run(batches):
        now, tokens, numbers = None, None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["range"] < 0:
                    rows.append((row["chunk"], -1, row["data"], row["at"], b""))
                    continue
                if row["chunk"] is None:
                    now, tokens = row["range"], _unpack(row["data"])
                    numbers = _from_planes(row["at"], "<u2")
                    continue
                if now != row["range"] or not len(tokens):
                    continue
                values = _unpack(row["data"])
                spot = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
                many = tokens[spot] == values
                if many.any():
                    at = _from_planes(row["at"], "<u4")[many]
                    n = numbers[spot[many]]
                    rows.append(
                        (row["chunk"], row["range"], _pack(values[many]), _planes(at, "<u4"), _planes(n, "<u2"))
                    )
            if rows:
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["chunk", "range", "data", "at", "n"],
                )

    # No more ranges are large than there are places for.
    large = counts.where(F.col("size") > 4 * RANGE_TOKENS).select(
        "range", F.ceil(F.col("size") / (2 * RANGE_TOKENS)).alias("salts")
    )
    deal = F.coalesce("salts", F.lit(1).cast("long"))
    left = places.join(F.broadcast(large), "range", "left").select(
        "range", "chunk", "data", "at", F.pmod(F.xxhash64("chunk"), deal).alias("salt")
    )
    right = counts.join(F.broadcast(large), "range", "left").select(
        "range", F.lit(None).cast("long").alias("chunk"), "data", F.col("n").alias("at"),
        F.explode(F.sequence(F.lit(0).cast("long"), deal - 1)).alias("salt"),
    )
    # A list of documents goes with its chunk, not to the one range -1.
    key = [F.when(F.col("range") >= 0, F.col("range")).otherwise(-1 - F.col("chunk")), F.col("salt")]
    both = left.unionByName(right).repartition(*key)
    return both.sortWithinPartitions("range", "salt", F.col("chunk").asc_nulls_first()).mapInArrow(
        run, _KNOWN
    )


# --- candidates ---------------------------------------------------------------------------


def prefixes(
    place: np.ndarray, token: np.ndarray, n: np.ndarray, sizes: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams are in the prefix of their document, and their places in its order.

    ``place`` (of the document), ``token`` and ``n`` tell all n-grams that occur more than
    once; ``sizes`` are those of all documents. Returns indices into them and places.
    """
    order = np.lexsort((token, n, place))
    listed = np.bincount(place, minlength=len(sizes))
    once = sizes - listed
    pos = np.arange(len(place)) - np.repeat(np.cumsum(listed) - listed, listed)
    pos += np.repeat(once, listed)
    in_order = place[order]
    inside = pos <= (sizes - needed(sizes, percent))[in_order]
    # N-grams that look alike in 40 bits are in or out together.
    for i in np.flatnonzero(~inside):
        if i and inside[i - 1] and in_order[i - 1] == in_order[i] and token[order[i - 1]] == token[order[i]]:
            inside[i] = True
    return order[inside], pos[inside]


def _postings(known: DataFrame, percent: int, run_rows: int) -> DataFrame:
    """Prefix n-grams that occur more than once: token, class, size, place, and whether the
    n-gram has many places."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        names = [r for r in rows if r["range"] < 0]
        rows = [r for r in rows if r["range"] >= 0]
        short = np.frombuffer(names[0]["data"], "<i8")
        sizes = np.frombuffer(names[0]["at"], "<i8")
        many = lambda key, read: np.concatenate([read(r[key]) for r in rows] or [np.zeros(0, int)])
        token = many("data", _unpack).astype(np.int64)
        place = many("at", lambda d: _from_planes(d, "<u4")).astype(np.int64)
        n = many("n", lambda d: _from_planes(d, "<u2")).astype(np.int64)
        got, pos = prefixes(place, token, n, sizes, percent)
        at = place[got]
        return pa.table(
            {
                "token": token[got], "short": short[at], "n": sizes[at].astype(np.int32),
                "pos": pos.astype(np.int32), "hot": n[got] > run_rows,
            }
        )

    return known.groupBy("chunk").applyInArrow(
        run, "token long, short long, n int, pos int, hot boolean"
    )


def may_link(n, pos, m, other, percent: int):
    """Length and positional filter of two sets that share the n-gram at these places (two
    more are allowed for n-grams that look alike in 40 bits)."""
    most = np.minimum(pos, other) + 3 + np.minimum(n - pos - 1, m - other - 1)
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return fits & (most >= pair_overlap(n, m, percent))


def _spanning(n, pos, short, percent: int, run_rows: int) -> list[tuple[int, int]]:
    """Links that connect all that ``may_link``; ``n`` rises."""
    out = []
    if len(n) > run_rows:
        # By neighbours in size, which connects all pairs that pass the length filter.
        near = (100 * n[:-1] >= percent * n[1:]) & (short[:-1] != short[1:])
        return list(zip(short[:-1][near].tolist(), short[1:][near].tolist()))
    left = np.arange(len(n))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = may_link(n[at], pos[at], n[left], pos[left], percent)
            found = left[near]
            out += [(int(short[at]), int(short[f])) for f in found if short[f] != short[at]]
            queue.extend(found.tolist())
            left = left[~near]
    return out


def _meet(percent: int, run_rows: int):
    """Links of the classes under each n-gram, from partitions sorted by it and size."""

    def links(token, short, n, pos) -> pa.RecordBatch:
        edge = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
        out = set()
        for i in np.flatnonzero(np.diff(edge) > 1):
            part = slice(edge[i], edge[i + 1])
            out.update(_spanning(n[part], pos[part], short[part], percent, run_rows))
        columns = list(zip(*out)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            part = [batch.column(c).to_numpy() for c in ("token", "short", "n", "pos")]
            part[2:] = [x.astype(np.int64) for x in part[2:]]
            if held is not None:
                part = [np.concatenate([h, p]) for h, p in zip(held, part)]
            if not len(part[0]):
                continue
            # The last n-gram may go on in the next batch.
            cut = int(np.searchsorted(part[0], part[0][-1]))
            held = [p[cut:] for p in part]
            if cut:
                yield links(*(p[:cut] for p in part))
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def _hot_links(postings: DataFrame, percent: int) -> DataFrame:
    """Links under n-grams of many classes: each class to the least one of its size band and
    of the next, which connects all classes whose lengths fit."""
    # A little wider than the ratio, so that rounding never parts fitting sizes by two bands.
    band = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100) * (1 + 1e-9)))
    rows = postings.select(
        "token", "short", F.explode(F.array(band, band + 1)).alias("band")
    )
    rows = rows.select(F.xxhash64("token", "band").alias("key"), "short").distinct()
    rows = stage_table(rows, "hot_postings")
    hubs = rows.groupBy("key").agg(F.min("short").alias("hub"), F.count("*").alias("m"))
    hubs = stage_table(hubs.where("m > 1"), "hubs")
    heavy = heavy_keys(hubs, "key", "m")
    met = salted_join(rows, hubs.drop("m"), "key", heavy, F.col("short"))
    return met.where("short != hub").select(F.col("short").alias("a"), F.col("hub").alias("b"))


def candidate_links(
    texts: DataFrame, ranges: int, words: int, percent: int, run_rows: int
) -> DataFrame:
    """Links (a, b) of classes that connect at least all pairs of linked sets."""
    counts = stage_table(_counts(texts, words, ranges), "ngram_counts")
    known = _known(_places(texts, words, ranges), counts)
    postings = stage_table(_postings(known, percent, run_rows), "prefix_ngrams")
    rows = postings.where("not hot")
    links = (
        rows.repartition("token").sortWithinPartitions("token", "n")
        .mapInArrow(_meet(percent, run_rows), "a long, b long")
    )
    return links.unionByName(_hot_links(postings.where("hot"), percent))


# --- verification -------------------------------------------------------------------------


def _filter(shorts: DataFrame) -> np.ndarray:
    """Bits of the linked classes' digests, in words; a set without its bit is in no link."""
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (16 * shorts.count()).bit_length()))
    place = F.pmod("short", F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    rows = shorts.groupBy(F.floor(place / 64).alias("at")).agg(F.bit_or(bit).alias("word"))
    out = np.zeros(bits // 64, dtype=np.int64)
    got = rows.toArrow()
    out[got.column("at").to_numpy()] = got.column("word").to_numpy()
    return out.view(np.uint64)


def _sets(texts: DataFrame, linked: np.ndarray, words: int) -> DataFrame:
    """class, short and tokens of the classes that the filter knows, once a task."""
    bits = np.int64(64 * len(linked))

    def run(batches):
        for new in _distinct(batches, words):
            short = _short([d for d, _ in new])
            at = (short % bits).view(np.uint64)
            known = linked[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
            kept = np.flatnonzero(known)
            if len(kept):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([new[i][0].hex() for i in kept]), pa.array(short[kept]),
                        pa.array([new[i][1].tobytes() for i in kept], pa.binary()),
                    ],
                    names=["class", "short", "tokens"],
                )

    rows = texts.mapInArrow(run, "class string, short long, tokens binary")
    return rows.groupBy("class").agg(F.first("short").alias("short"), F.first("tokens").alias("tokens"))


def verified_links(sets: list[np.ndarray], group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the places of ``sets`` that are similar enough; places of one
    ``group`` are connected already."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    own = [ids[starts[i] : starts[i + 1]] for i in order]
    parts = np.array([np.bincount(x % PARTS, minlength=PARTS) for x in own], dtype=np.int64)
    mark = np.zeros(ids.max() + 1, dtype=bool)
    members: dict[int, list[int]] = {}
    for place, i in enumerate(order):
        members.setdefault(int(group[i]), []).append(place)
    left = np.ones(len(own), dtype=bool)
    out = []

    def reached(place: int) -> list[int]:
        """The place and all that are connected with it already."""
        found = members.pop(int(group[order[place]]), [])
        left[found] = False
        return found

    for first in range(len(own)):
        if not left[first]:
            continue
        queue = reached(first)
        while queue:
            at = queue.pop()
            n = int(sizes[at])
            # Sizes that may link are one stretch.
            low = int(np.searchsorted(sizes, needed(n, percent)))
            high = int(np.searchsorted(sizes, 100 * n // percent, side="right"))
            near = low + np.flatnonzero(left[low:high])
            if not len(near):
                continue
            least = pair_overlap(n, sizes[near], percent)
            apart = np.abs(parts[near] - parts[at]).sum(axis=1)
            near = near[apart <= n + sizes[near] - 2 * least]
            if not len(near):
                continue
            mark[own[at]] = True
            for other in near.tolist():
                if left[other] and mark[own[other]].sum() >= pair_overlap(n, int(sizes[other]), percent):
                    out.append((int(order[at]), int(order[other])))
                    queue.extend(reached(other))
            mark[own[at]] = False
    return out


def _verify(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sets = [np.frombuffer(t, np.uint64) for t in group.column("tokens").to_pylist()]
        known = {c: i for i, c in enumerate(dict.fromkeys(group.column("part").to_pylist()))}
        parts = np.array([known[c] for c in group.column("part").to_pylist()])
        links = verified_links(sets, parts, percent)
        names = group.column("class")
        columns = list(zip(*links)) or [(), ()]
        return pa.table(
            {k: pa.array([names[i].as_py() for i in c], pa.string()) for k, c in zip("ab", columns)}
        )

    return run


def _in_groups(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Verified links within each group of rows (keys, class, part, tokens)."""
    rows = rows.select(*keys, "class", "part", "tokens")
    return rows.groupBy(*keys).applyInArrow(_verify(percent), "a string, b string")


def _numbers(n):
    return F.sequence(F.lit(0).cast("long"), n - 1)


def _connected(sets: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """Verified links that connect the similar ``sets`` (root, class, tokens) of each root."""
    size = (F.length("tokens") / 8).cast("long")
    roots = sets.groupBy("root").agg(F.sum(size).alias("size"), F.count("*").alias("n"))
    roots = stage_table(roots, "candidate_roots")
    large = roots.where(F.col("size") > block_tokens).select(
        "root", F.col("n").alias("classes"),
        F.ceil(2 * F.col("size") / block_tokens).cast("long").alias("blocks"),
    )
    large = stage_table(large, "large_roots")
    rows = lookup(sets, large, "root", F.col("class"), roots, "n", "left")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    shared = F.pmod(F.xxhash64("class", F.lit(1)), F.col("classes")) < SHARED
    block = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).when(
        shared, _numbers(F.col("blocks"))
    ).otherwise(F.array(own))
    first = rows.select(
        "root", F.explode(block).alias("block"), "class", F.col("class").alias("part"), "tokens"
    )
    links = stage_table(_in_groups(first, ["root", "block"], percent), "verified_links")
    if large.isEmpty():
        return links
    # What the blocks of a large root leave apart, against all of that root.
    parts = components(links).select(F.col("node").alias("class"), F.col("root").alias("part"))
    rows = rows.where("blocks is not null").join(parts, "class", "left").withColumn(
        "part", F.coalesce("part", "class")
    )
    rows = stage_table(rows, "large_sets")
    by_part = rows.groupBy("root", "part").agg(F.sum(size).alias("size"))
    roomy = by_part.groupBy("root").agg(
        F.max(F.struct("size", "part")).alias("main"), F.sum("size").alias("size")
    )
    rest = (F.col("size") - F.col("main.size")).alias("rest")
    roomy = roomy.select("root", F.col("main.part").alias("main"), rest).where("rest > 0").select(
        "root", "main", F.ceil(2 * F.col("rest") / block_tokens).cast("long").alias("others")
    )
    roomy = stage_table(roomy, "parted_roots")
    rows = lookup(rows, roomy, "root", F.col("class"), roots, "n")
    # Each class meets every block of the rest; each of the rest every block of the root.
    meets_rest = rows.select(
        "root", "class", "part", "tokens", F.explode(_numbers(F.col("others"))).alias("other"),
        own.alias("block"),
    )
    of_rest = rows.where("part != main").select(
        "root", "class", "part", "tokens",
        F.pmod(F.xxhash64("class", F.lit(2)), F.col("others")).alias("other"),
        F.explode(_numbers(F.col("blocks"))).alias("block"),
    )
    both = meets_rest.unionByName(of_rest)
    return links.unionByName(_in_groups(both, ["root", "other", "block"], percent))


def similar_classes(
    texts: DataFrame, n_tokens: int, *, words: int = WORDS, percent: int = PERCENT,
    run_rows: int = RUN_ROWS, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``node`` and ``root``, the least class of its component, of each class that is linked
    and not the root itself. ``n_tokens``: about how many n-grams the ``text`` s have."""
    if run_rows > _MOST:
        raise ValueError(f"run_rows is {_MOST} at most")
    ranges = max(16, -(-n_tokens // RANGE_TOKENS))
    links = candidate_links(texts, ranges, words, percent, run_rows)
    links = stage_table(links, "candidates")
    rooted = components(links)
    rooted = rooted.unionByName(
        rooted.select(F.col("root").alias("node"), "root").distinct()
    ).withColumnRenamed("node", "short")
    rooted = stage_table(rooted, "candidate_classes")
    sets = _sets(texts, _filter(rooted.select("short")), words)
    sets = stage_table(sets.join(rooted, "short").select("root", "class", "tokens"), "candidate_sets")
    return components(_connected(sets, percent, block_tokens))


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = WORDS,
    percent: int = PERCENT, **how,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stage_table(_classes(rows, words), "ngram_sets")
    classes = found.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("n").alias("n")
    )
    classes = stage_table(classes, "ngram_classes")
    n_tokens = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    texts = rows.select("text").where("text is not null")
    linked = similar_classes(texts, n_tokens, words=words, percent=percent, **how)
    linked = linked.withColumnRenamed("node", "class")
    rooted = stage_table(
        classes.join(linked, "class", "left").select(
            "class", "low", F.coalesce("root", "class").alias("root")
        ),
        "rooted_classes",
    )
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("m"))
    named = stage_table(named, "components")
    heavy = heavy_keys(named.where("m > 1"), "root", "m")
    labels = salted_join(rooted, named.drop("m"), "root", heavy, F.col("class"))
    labels = labels.select("class", "component_id")
    heavy = heavy_keys(classes.where("copies > 1"), "class", "copies")
    out = salted_join(found, labels, "class", heavy, F.coalesce("doc_id", F.rand(0)), "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
