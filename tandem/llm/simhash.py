"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``max_bits`` or fewer differing bits. The bits are dealt
into parts, correlated bits together. If the parts' thresholds, each one more than it
says, add up to ``max_bits`` + 1, a linked pair is within its threshold in at least one
part. Dynamic programming finds the thresholds, and the number of parts, with the least
estimated work from a bounded sample of fingerprints; they decide the cost, never the
result. Each fingerprint probes the values within the threshold of each part, and the
distinct fingerprints that meet under one value are verified and linked by a spanning
forest: as many links as fingerprints at most, however dense the group. A value with more
than ``RUN_ROWS`` fingerprints is verified in pairs of blocks, each a group by itself.

Defined results: a text that is null or has no word has fingerprint zero, which links
like any other. Repeated rows each get a row. A row without ``doc_id`` gets the component
of its text, whose name is the least id there is in it, or null if there is none.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .components import components
from .tables import row_key, stage_table

WORDS = 4
SEED = 42
BITS = 64
MAX_BITS = 4
#: Fingerprints sampled to deal the bits and to estimate candidates.
SAMPLE = 4096
#: Fingerprints under one value that are verified in one group.
RUN_ROWS = 16_384
#: Work of verifying a candidate pair, as a share of that of shuffling a probe.
PAIR_COST = 0.02

_CHUNK = 1 << 16


def fingerprint_texts(texts: pa.Array) -> np.ndarray:
    """Fingerprints of texts, as unsigned 64-bit values."""
    words = bw.split_words(texts, bw.NOT_SPACE)
    n = words.counts()
    size = np.minimum(n, WORDS)
    runs = np.where(n > 0, n - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), runs)
    first = words.bounds[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = words.starts[first].tolist()
    ends = words.ends[first + size[doc] - 1].tolist()
    data, digest = words.data.tobytes(), xxhash.xxh64_intdigest
    set_bits = np.zeros((len(n), BITS), dtype=np.int64)
    for at in range(0, len(doc), _CHUNK):
        part = slice(at, at + _CHUNK)
        h = np.array(
            [digest(data[s:e], SEED) for s, e in zip(starts[part], ends[part])], dtype=np.uint64
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs, edges = np.unique(doc[part], return_index=True)
        set_bits[docs] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
    most = 2 * set_bits > runs[:, None]
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for batch in bw.slices(batches, "text"):
            fp = fingerprint_texts(batch.column("text")).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


# --- parts and thresholds ---------------------------------------------------------------


def deal_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, correlated bits together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    with np.errstate(invalid="ignore", divide="ignore"):
        near = np.abs(np.nan_to_num(np.corrcoef(bits.T.astype(float)), nan=1.0))
    left, out = list(range(BITS)), []
    for i in range(parts):
        room = len(left) // (parts - i)
        group = [max(left, key=lambda b: near[b, left].sum())]
        left.remove(group[0])
        while len(group) < room:
            best = max(left, key=lambda b: near[b, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def part_values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    value = np.zeros(len(fp), dtype=np.uint64)
    for i, b in enumerate(bits):
        value |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return value


def estimate(sample: np.ndarray, bits: list[int], n: float, most: int) -> list[float]:
    """Work of a part for thresholds -1 (the part is left out) to ``most``."""
    value = part_values(sample, bits)
    near = np.zeros(most + 1)
    pairs = max(1, len(value) * (len(value) - 1) // 2)
    for at in range(len(value)):
        d = np.bitwise_count(value[at] ^ value[at + 1 :])
        near += np.bincount(d[d <= most], minlength=most + 1)
    width, out, probes = len(bits), [0.0], 0
    for t in range(most + 1):
        probes += comb(width, t)
        # Half a sampled pair is the least that a sample can tell from none.
        share = max(near[: t + 1].sum(), 0.5 * (near[: t + 1].sum() > 0)) / pairs
        share = max(share, probes / 2.0**width)
        out.append(n * probes + PAIR_COST * n * n * share)
    return out


def allocate(work: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Thresholds with the least total work; each part's threshold plus one are its
    units, and ``units`` are dealt out in all."""
    best = {0: (0.0, [])}
    for costs in work:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for u, cost in enumerate(costs):
                if used + u <= units and (
                    used + u not in step or total + cost < step[used + u][0]
                ):
                    step[used + u] = (total + cost, [*chosen, u - 1])
        best = step
    return best[units]


def plan(sample: np.ndarray, n: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """Parts (bits, threshold) to probe for ``n`` fingerprints like the sampled ones."""
    best = None
    for parts in range(2, max_bits + 2):
        groups = deal_bits(sample, parts)
        most = max(0, min(3, max_bits))
        work = [estimate(sample[:1024], g, float(n), most) for g in groups]
        if (most + 1) * parts < max_bits + 1:
            continue
        total, thresholds = allocate(work, max_bits + 1)
        if best is None or total < best[0]:
            best = (total, [(g, t) for g, t in zip(groups, thresholds) if t >= 0])
    return best[1]


# --- probing and verifying --------------------------------------------------------------


def _probes(parts: list[tuple[list[int], int]]):
    masks = [
        np.array(
            [
                sum(1 << i for i in flips)
                for d in range(t + 1)
                for flips in combinations(range(len(bits)), d)
            ],
            dtype=np.uint64,
        )
        for bits, t in parts
    ]

    def run(batches):
        for batch in batches:
            signed = batch.column("fp").to_numpy()
            for at in range(0, len(signed), 4096):
                part = signed[at : at + 4096]
                for i, (bits, _) in enumerate(parts):
                    value = part_values(part.view(np.uint64), bits)
                    key = (value[:, None] ^ masks[i][None, :]) | np.uint64(i << 56)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.ravel().view(np.int64)),
                            pa.array(np.repeat(part, len(masks[i]))),
                        ],
                        names=["key", "fp"],
                    )

    return run


def spanning_links(fp: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links that connect what pairs within ``max_bits`` bits connect, no cycles."""
    left = np.unique(fp)
    one, other = [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(at ^ left) <= max_bits
            if near.any():
                found = left[near]
                one.extend([at] * len(found)), other.extend(found)
                queue.extend(found)
                left = left[~near]
    return one, other


def _verify(max_bits: int):
    def links(key: np.ndarray, block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        starts = np.concatenate([[0], edge])
        ends = np.concatenate([edge, [len(key)]])
        one, other = [], []
        for s, e in zip(starts, ends):
            if e - s == 2:
                if fp[s] != fp[s + 1] and (fp[s] ^ fp[s + 1]).bit_count() <= max_bits:
                    one.append(fp[s]), other.append(fp[s + 1])
            elif e - s > 2:
                a, b = spanning_links(fp[s:e], max_bits)
                one.extend(a), other.extend(b)
        as_long = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([as_long(one), as_long(other)], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            part = [batch.column(i).to_numpy() for i in range(3)]
            part[2] = part[2].view(np.uint64)
            if held is not None:
                part = [np.concatenate([h, p]) for h, p in zip(held, part)]
            if not len(part[0]):
                continue
            # The last run may go on in the next batch.
            same = (part[0] == part[0][-1]) & (part[1] == part[1][-1])
            cut = len(same) - int(same.sum())
            held = [p[cut:] for p in part]
            if cut:
                yield links(*(p[:cut] for p in part))
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def link_fingerprints(
    fps: DataFrame, max_bits: int = MAX_BITS, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect the same ones as
    all pairs within ``max_bits`` bits do."""
    rows = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE).toPandas()["fp"].to_numpy(np.int64)
    schema = "a long, b long"
    if len(rows) < 2:
        return fps.sparkSession.createDataFrame([], schema)
    parts = plan(rows.view(np.uint64), fps.count(), max_bits)
    probes = fps.mapInArrow(_probes(parts), "key long, fp long")
    large = (
        probes.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > run_rows)
        .select("key", F.ceil(2 * F.col("n") / run_rows).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = F.transform(
        other, lambda i: F.least(own, i) * F.col("blocks") + F.greatest(own, i)
    )
    runs = probes.join(large, "key", "left").select(
        "key",
        F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(met)).alias("block"),
        "fp",
    )
    return (
        runs.repartition("key", "block").sortWithinPartitions("key", "block")
        .mapInArrow(_verify(max_bits), schema)
    )


def near_duplicates(
    docs: DataFrame, max_bits: int = MAX_BITS, run_rows: int = RUN_ROWS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every row of ``docs``."""
    prints = stage_table(fingerprints(docs), "fingerprints")
    fps = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fp")
    linked = components(link_fingerprints(fps.select("fp"), max_bits, run_rows))
    rooted = fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, the one with the least id, all columns as they were.

    Rows with the same id and another text are documents of their own; of those in one
    group, and of repeated rows, one stays. A row without an id stays.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    named = docs.where("doc_id is not null").select(
        F.struct("doc_id", key.alias("key")).alias("doc_id"), "text"
    )
    kept = near_duplicates(named, max_bits).where("doc_id = component_id")
    pair = ["doc_id", "_row_key"]
    kept = kept.select("doc_id.doc_id", F.col("doc_id.key").alias("_row_key")).distinct()
    stays = docs.where("doc_id is not null").withColumn("_row_key", key)
    stays = stays.join(kept, pair, "left_semi").dropDuplicates(pair)
    return stays.select(docs.columns).unionByName(docs.where("doc_id is null"))
