"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``SIZE`` consecutive words of an item, or a whole item of fewer. It is a set of
short shingles with places. To contain the window a document must contain each of its
shingles, so the prefix of one, the rarest over all documents, is enough to find every
place where it can be. A place found is a window only if the shingle's position leaves
room for the window before it and the document's length leaves room after it, and if the
words are the same one by one.

Two passes read the texts: one counts the benchmark's shingles in all documents, one looks
up the rarest of each window. Both test words against a bitmap of fixed size, so what is
sent to the executors does not grow with the benchmark; what the bitmap lets through by
chance falls out in the join. One passage may be in a third of all documents: the counts of
the first pass tell which prefixes own a large share of the rows, and those are salted by
document, one salt for each share.

Defined results: a null or empty text has no words and is not hit. Items without words have
no windows. An item without id marks words but is not listed. Repeated rows of documents
each get a row; repeated rows of the benchmark change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, salted_join
from . import bytewords as bw
from .tables import row_key, sha256_of, stage_table

SIZE = 13
#: Words of a shingle.
SHINGLE = 3
#: Bits of the bitmaps (2 MB).
FILTER_BITS = 24


def _runs(words: bw.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run of ``size`` words stays in its text, and the runs' hashes."""
    value = bw.shingles(words.hashes(), size)
    at = np.flatnonzero(bw.inside(words.bounds, size, len(value)))
    return at, value[at]


def item_windows(benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Windows: ``item_id``, ``window`` (words with spaces), ``n``, ``keys`` (shingles)."""

    def run(batches):
        for batch in bw.slices(batches, "text"):
            words = bw.split_words(batch.column("text"), bw.ALPHANUMERIC)
            ids = batch.column("item_id")
            hashes = words.hashes()
            out = []
            for t, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                n = min(size, int(b - a))
                for at in range(int(a), int(b) - n + 1) if n else ():
                    keys = bw.shingles(hashes[at : at + n], min(shingle, n)).view(np.int64)
                    out.append((ids[t].as_py(), words.join(at, at + n), n, keys.tolist()))
            columns = list(zip(*out)) or [[]] * 4
            kinds = (ids.type, pa.string(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["item_id", "window", "n", "keys"],
            )

    rows = benchmark.select("item_id", "text")
    kind = rows.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, window string, n int, keys array<bigint>"
    return rows.mapInArrow(run, schema).distinct()


def bitmap(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits in which the bits of all ``key`` are set."""
    at = f"key & {(1 << bits) - 1}"
    table = (
        keys.groupBy(F.expr(f"shiftright({at}, 5)").alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(key & 31 as int)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out


def _passes(filter_bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(32 * len(filter_bits) - 1)
    word = filter_bits[(at >> np.uint64(5)).astype(np.int64)]
    return (word >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def shingle_counts(docs: DataFrame, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """How often each of ``keys`` (key) is in the documents: ``key``, ``df``."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(keys))

    def run(batches):
        for batch in bw.slices(batches, "text"):
            words = bw.split_words(batch.column("text"), bw.ALPHANUMERIC)
            found = [_runs(words, size)[1] for size in sizes]
            found = np.concatenate([v[_passes(shared.value, v)] for v in found])
            key, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"]
            )

    counted = docs.select("text").mapInArrow(run, "key long, n long")
    counted = counted.groupBy("key").agg(F.sum("n").alias("n"))
    return keys.join(counted, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("df"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with the place of its rarest shingle: ``key``, ``place`` and ``df``."""
    places = windows.select("window", F.posexplode("keys").alias("place", "key")).distinct()
    rarest = (
        places.join(counts, "key")
        .groupBy("window")
        .agg(F.min(F.struct("df", "key", "place")).alias("first"))
        .select("window", "first.key", "first.place", "first.df")
    )
    return windows.drop("keys").join(rarest, "window")


def _candidates(filter_bits, sizes: list[int], window: int):
    def run(batches):
        for batch in bw.slices(batches, "text"):
            words = bw.split_words(batch.column("text"), bw.ALPHANUMERIC)
            at, key = [], []
            for size in sizes:
                places, values = _runs(words, size)
                ok = _passes(filter_bits.value, values)
                at.append(places[ok]), key.append(values[ok])
            at, key = np.concatenate(at), np.concatenate(key)
            doc = np.searchsorted(words.bounds, at, side="right") - 1
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for p, k, d in zip(at.tolist(), key.view(np.int64).tolist(), doc.tolist()):
                a, b = int(words.bounds[d]), int(words.bounds[d + 1])
                low, high = max(a, p - window), min(b, p + window)
                found[d].append((k, p - a, low - a, words.join(low, high)))
            kind = pa.list_(pa.struct([
                ("key", pa.int64()), ("at", pa.int64()), ("low", pa.int64()), ("near", pa.string())
            ]))
            named = [[dict(zip(("key", "at", "low", "near"), x)) for x in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(words.counts()),
                 pa.array(named, kind)],
                names=["row", "doc_id", "n_words", "found"],
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): ``row`` (a number of its own), ``doc_id``,
    ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids as strings)."""
    windows = stage_table(item_windows(benchmark, size), "windows")
    sizes = [
        r[0] for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("s")).distinct()
        .orderBy("s").collect()
    ] or [SHINGLE]
    keys = windows.select(F.explode("keys").alias("key")).distinct()
    first = stage_table(prefixes(windows, shingle_counts(docs, keys, sizes)), "prefixes")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(first.select("key").distinct()))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(
        _candidates(shared, sizes, size),
        f"row long, doc_id {kind}, n_words long, "
        "found array<struct<key: bigint, at: bigint, low: bigint, near: string>>",
    )
    # A row without a place to look at keeps a key that no window has, spread by row.
    rows = rows.select("row", "doc_id", "n_words", F.explode_outer("found").alias("f")).select(
        "row", "doc_id", "n_words", "f.at", "f.low", "f.near",
        F.coalesce("f.key", "row").alias("key"),
    )
    heavy = heavy_keys(first.where("df > 0").select("key", "df").distinct(), "key", "df")
    placed = first.select("item_id", "window", "n", "key", "place")
    start, low = F.col("at") - F.col("place"), F.col("low")
    same = (
        (start >= low)
        & (start + F.col("n") <= F.col("n_words"))
        & (
            F.array_join(F.slice(F.split("near", " "), (start - low + 1).cast("int"), F.col("n")), " ")
            == F.col("window")
        )
    )
    span = F.struct(start.alias("a"), (start + F.col("n")).alias("b"))
    hit = F.coalesce(F.col("at").isNotNull() & F.col("window").isNotNull() & same, F.lit(False))
    joined = salted_join(rows, placed, "key", heavy, F.col("row"), "left")
    met = joined.groupBy("row", "doc_id", "n_words").agg(
        F.collect_set(F.when(hit, span)).alias("spans"),
        F.array_sort(F.collect_set(F.when(hit, F.col("item_id").cast("string")))).alias("items"),
    )
    return met.select(
        "row", "doc_id", "n_words", _covered(F.array_sort("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items",
    )


def _covered(spans):
    """Words inside any of the spans, which are sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["b"] - F.greatest(s["a"], acc["end"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(acc["end"], s["b"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def judged(found: DataFrame) -> DataFrame:
    """Add ``items_sha256`` and ``contaminated`` (a twentieth of the words is hit)."""
    return found.withColumns({
        "items_sha256": sha256_of(F.array_join("items", ",")),
        "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
    })


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were.

    A contaminated row takes all rows with the same id and text with it.
    """
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    bad = judged(contamination(keyed, benchmark)).where("contaminated")
    bad = stage_table(bad.select(F.col("doc_id").alias("_row_key")).distinct(), "contaminated")
    key = row_key(F.col("doc_id"), F.col("text"))
    return docs.join(bad, key == F.col("_row_key"), "left_anti")
