"""Hard negatives by candidate lists that all anchors of a cluster share.

Vectors are quantised to whole numbers, ``floor(scale * x)``, and packed in chunks of rows.
Anchors are clustered by direction around centres learnt from a bounded sample of them. For
each cluster a chunk's rows are sorted once by an upper bound of their score with any anchor
of the cluster: the length of a row times the cosine of the angle that is left between its
direction and the cluster's cone. Every anchor walks that list, blocks of anchors at once,
and stops where the bound falls below what can still change its result. A first walk finds
the positives, a second one, with the positives known, the negatives under each of them.
Both lists of results are cut to the best k per chunk and merged by rank, so nothing but k
rows an anchor (or positive) and chunk is shuffled. Where there are many chunks, some of
them are walked first, and what they hold is the least that the others must offer.

The bound never falls below a score, so the result is exact on any data; data without
directions only leave nothing to skip. Anchors are a stated share of the rows, in blocks of
``ANCHOR_BLOCK`` that are broadcast one after another.

Defined results: a row without label or vector, or with a component that is null or not
finite, takes no part. Missing components of a shorter vector count as zero, and an empty
vector scores zero with all. Repeated rows are rows of their own: an anchor's copy may be
its positive. Ties go to the smaller id, nulls last. A positive below zero has no negatives,
as its window is empty. A score that no long can hold raises an error. No rows, no anchors
or a single label give an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stage_table

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative scores between so many hundredths of its positive's score and all of it.
LEAST_PERCENT = 80

#: Rows of a chunk; their places fit 16 bits.
CHUNK = 8192
#: Clusters of anchors, and the anchors sampled to find them.
CLUSTERS, SAMPLE = 16, 8192
#: Anchors broadcast at once.
ANCHOR_BLOCK = 32_768
#: Chunks that are walked first where there are more.
HEAD_CHUNKS = 64
#: Rows of a list, and anchors, that are scored at once.
STEP, MEMBERS = 1024, 512

_NONE = np.iinfo(np.int64).min


# --- packed rows --------------------------------------------------------------------------


def taking_part(
    rows: DataFrame, row_id: str, vector: str, label: Column, anchor: Column
) -> DataFrame:
    """Rows that take part: id, label, anchor and ``x``, the vector in doubles."""
    taken = rows.select(
        F.col(row_id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(F.col(vector), lambda v: v.cast("double")).alias("x"),
    ).where("label is not null and x is not null")
    return taken.where(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as one matrix, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and sizes.min() == width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _whole(column: pa.Array, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component."""
    q = np.floor(scale * _matrix(column))
    if not np.isfinite(q).all():
        raise ValueError("a component is too large")
    return q


def _packed(q: np.ndarray) -> tuple[bytes, bool]:
    small = not q.size or np.abs(q).max() < 32768
    return (q.astype("<i2" if small else "<f8").tobytes(), bool(small))


def _unpacked(data: bytes, small: bool, n: int) -> np.ndarray:
    flat = np.frombuffer(data, "<i2" if small else "<f8").astype(float)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


_CHUNK_SCHEMA = pa.schema(
    [("rows", pa.binary()), ("n", pa.int32()), ("ids", pa.binary()), ("nulls", pa.binary()),
     ("labels", pa.binary()), ("q", pa.binary()), ("small", pa.bool_())]
)


def _chunks(scale: int, size: int):
    def run(batches):
        held: list[pa.RecordBatch] = []

        def full(rows: pa.Table):
            rows = rows.combine_chunks()
            ids = rows.column("id").combine_chunks()
            data, small = _packed(_whole(rows.column("x").combine_chunks(), scale))
            return pa.RecordBatch.from_pylist(
                [{
                    "rows": rows.column("row").to_numpy().astype("<i8").tobytes(), "n": len(ids),
                    "ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                    "nulls": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    "labels": rows.column("label").to_numpy().astype("<i8").tobytes(),
                    "q": data, "small": small,
                }],
                schema=_CHUNK_SCHEMA,
            )

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= size:
                yield full(rows.slice(0, size))
                rows = rows.slice(size)
            held = rows.combine_chunks().to_batches() if rows.num_rows else []
        if held:
            yield full(pa.Table.from_batches(held))

    return run


# --- clusters and lists -------------------------------------------------------------------


def _unit(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has direction zero."""
    size = np.sqrt((q * q).sum(axis=1))
    return q / np.where(size > 0, size, 1)[:, None], size


def _wide(q: np.ndarray, width: int) -> np.ndarray:
    """The same vectors with ``width`` components at least."""
    if q.shape[1] >= width:
        return q
    return np.hstack([q, np.zeros((len(q), width - q.shape[1]))])


def find_centres(sample: np.ndarray, clusters: int = CLUSTERS, rounds: int = 10) -> np.ndarray:
    """Centres of directions by spherical k-means."""
    unit, _ = _unit(sample)
    rng = np.random.default_rng(0)
    centres = unit[rng.choice(len(unit), min(clusters, len(unit)), replace=False)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = unit[near == c].sum(axis=0)
        centres, _ = _unit(centres)
    return centres


def _angles(q: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angle of each row to each centre, and the rows' lengths."""
    width = max(q.shape[1], centres.shape[1])
    unit, size = _unit(_wide(q, width))
    return np.arccos(np.clip(unit @ _wide(centres, width).T, -1, 1)), size


def bounds(q: np.ndarray, centres: np.ndarray, cones: np.ndarray) -> np.ndarray:
    """By row and cluster: no anchor of length one within the cone scores more."""
    angle, size = _angles(q, centres)
    # What rounding may hide in an angle and in the product.
    left = np.maximum(angle - cones[None, :] - 1e-6, 0)
    return (np.cos(left) * (1 + 1e-9) + 1e-9) * size[:, None]


def _lists(centres: np.ndarray, cones: np.ndarray):
    """Attach each cluster's list: the places of the rows by falling bound, and the bounds."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q = _unpacked(row["q"], row["small"], row["n"])
                bound = bounds(q, centres, cones)
                order = np.argsort(-bound, axis=0, kind="stable")
                falling = np.take_along_axis(bound, order, axis=0)
                # As 32 bits, rounded up.
                short = np.nextafter(falling.astype("<f4"), np.float32(np.inf))
                row["places"] = order.T.astype("<u2").tobytes()
                row["bounds"] = short.T.tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=_LIST_SCHEMA)

    return run


_LIST_SCHEMA = _CHUNK_SCHEMA.append(pa.field("places", pa.binary())).append(
    pa.field("bounds", pa.binary())
)


# --- walks --------------------------------------------------------------------------------


class Scores:
    """Whole inner products, and keys that rank them: by score, then by id."""

    def __init__(self, anchors: np.ndarray, chunk: dict):
        self.n = chunk["n"]
        self.q = _unpacked(chunk["q"], chunk["small"], self.n)
        self.rows = np.frombuffer(chunk["rows"], "<i8")
        self.ids = np.frombuffer(chunk["ids"], "<i8")
        self.nulls = np.frombuffer(chunk["nulls"], bool)
        self.labels = np.frombuffer(chunk["labels"], "<i8")
        width = max(self.q.shape[1], anchors.shape[1])
        self.q, self.anchors = _wide(self.q, width), _wide(anchors, width)
        most = float(np.abs(self.q).max(initial=0)) * float(np.abs(self.anchors).max(initial=0))
        # Sums of doubles are exact below 2 ** 53; a key needs 14 bits beside its score.
        self.exact = most * max(width, 1) < 2.0**48
        #: Less than any key.
        self.none = _NONE if self.exact else -(1 << 90)
        by_id = np.lexsort((np.arange(self.n), self.ids, self.nulls))
        self.rank = np.empty(self.n, dtype=np.int64)
        self.rank[by_id] = np.arange(self.n)
        self.by_id = by_id

    def block(self, members: np.ndarray, places: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.anchors[members] @ self.q[places].T).astype(np.int64)
        out = np.empty((len(members), len(places)), dtype=object)
        whole = [[int(x) for x in row] for row in self.q[places]]
        for i, m in enumerate(members):
            a = [int(x) for x in self.anchors[m]]
            out[i] = [sum(x * y for x, y in zip(a, row)) for row in whole]
        if out.size and max(abs(x) for x in out.ravel().tolist()) >= 1 << 63:
            raise ValueError("a score exceeds 64 bits; the vectors are too long")
        return out

    def keys(self, scores: np.ndarray, places: np.ndarray) -> np.ndarray:
        return scores * (2 * CHUNK) + (2 * CHUNK - 1 - self.rank[places])[None, :]

    def of(self, key) -> tuple[int, int]:
        """Score and place of a key."""
        score, rest = divmod(int(key), 2 * CHUNK)
        return score, int(self.by_id[2 * CHUNK - 1 - rest])


def _best(kept: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """The k greatest of each row of both, greatest first."""
    both = np.concatenate([kept, keys], axis=1)
    if both.dtype == object:
        return np.sort(both, axis=1)[:, ::-1][:, :k]
    if both.shape[1] > 4 * k:
        both = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
    return np.sort(both, axis=1)[:, ::-1][:, :k]


def _empty(shape, held: Scores) -> np.ndarray:
    return np.full(shape, held.none, dtype=np.int64 if held.exact else object)


def _walk(chunk: dict, block: dict, lists: int, offers):
    """Walk a chunk's lists for a block of anchors.

    ``offers(scores, members)`` makes an object with ``take(live, places, scores)`` and
    ``least(live)``, the score below which a row can no longer change a member's result.
    """
    held = Scores(block["q"], chunk)
    places = np.frombuffer(chunk["places"], "<u2").reshape(lists, -1)
    limit = np.frombuffer(chunk["bounds"], "<f4").reshape(lists, -1)
    for cluster in range(lists):
        in_cluster = np.flatnonzero(block["cluster"] == cluster)
        for at in range(0, len(in_cluster), MEMBERS):
            members = in_cluster[at : at + MEMBERS]
            offer = offers(held, members)
            live = np.arange(len(members))
            for s in range(0, held.n, STEP):
                # One of slack beyond rounding: scores are whole numbers.
                top = limit[cluster, s].astype(float) * block["size"][members[live]] + 1
                live = live[top >= offer.least(live)]
                if not len(live):
                    break
                at_once = places[cluster, s : s + STEP].astype(np.int64)
                offer.take(live, at_once, held.block(members[live], at_once))
            yield held, members, offer


def _positives(block: dict, lists: int, k: int):
    class Offer:
        def __init__(self, held, members):
            self.held, self.members = held, members
            self.kept = _empty((len(members), k), held)
            self.floor = block["floor"][members]

        def least(self, live):
            # A floor of another chunk may be met with an equal score and a smaller id.
            score = (self.kept[live, k - 1] // (2 * CHUNK)).astype(float)
            return np.maximum(score, self.floor[live])

        def take(self, live, places, scores):
            held, members = self.held, self.members[live]
            fits = held.labels[places][None, :] == block["label"][members][:, None]
            fits &= held.rows[places][None, :] != block["row"][members][:, None]
            fits &= scores >= self.floor[live][:, None]
            keys = np.where(fits, held.keys(scores, places), _empty((1, 1), held))
            self.kept[live] = _best(self.kept[live], keys, k)

    def run(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                out = []
                for held, members, offer in _walk(chunk, block, lists, Offer):
                    for m, row in zip(members.tolist(), offer.kept):
                        for key in row:
                            if key == held.none:
                                break
                            score, place = held.of(key)
                            out.append((m, score, _id(held, place), int(held.rows[place])))
                yield _longs(out, ["anchor", "score", "id", "row"])

    return run


def _longs(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _id(held: Scores, place: int):
    return None if held.nulls[place] else int(held.ids[place])


def _negatives(block: dict, wanted: dict, lists: int, k: int, percent: int):
    """``wanted``: positives' scores by anchor (rows) and rank (columns), _NONE where none."""
    score_of, floor_of = wanted["score"], wanted["floor"]
    some = score_of != _NONE

    class Offer:
        def __init__(self, held, members):
            self.held, self.members = held, members
            self.score, self.some = score_of[members], some[members]
            self.floor = floor_of[members]
            self.kept = _empty((*self.score.shape, k), held)

        def least(self, live):
            kept = (self.kept[live, :, k - 1] // (2 * CHUNK)).astype(float)
            need = np.maximum(np.maximum(kept, self.floor[live]), self.score[live] * (percent / 100) - 1)
            # A window below zero is empty, and nobody waits for it.
            need = np.where(self.some[live] & (self.score[live] >= 0), need, np.inf)
            return need.min(axis=1)

        def take(self, live, places, scores):
            held = self.held
            other = held.labels[places][None, :] != block["label"][self.members[live]][:, None]
            keys = held.keys(scores, places)
            for j in range(self.score.shape[1]):
                top = self.score[live, j][:, None]
                if not held.exact:
                    top = top.astype(object)
                fits = other & (scores <= top) & (100 * scores >= percent * top)
                fits &= self.some[live, j][:, None] & (scores >= self.floor[live, j][:, None])
                own = np.where(fits, keys, _empty((1, 1), held))
                self.kept[live, j] = _best(self.kept[live, j], own, k)

    def run(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                out = []
                for held, members, offer in _walk(chunk, block, lists, Offer):
                    for i, j in np.argwhere(offer.kept[:, :, 0] != held.none).tolist():
                        for key in offer.kept[i, j]:
                            if key == held.none:
                                break
                            score, place = held.of(key)
                            out.append(
                                (int(members[i]), j, score, _id(held, place), int(held.rows[place]))
                            )
                yield _longs(out, ["anchor", "positive", "score", "id", "row"])

    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    return found.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ).where(F.col("rank") <= k)


# --- the whole ----------------------------------------------------------------------------


def _anchor_block(
    anchors: DataFrame, block: int, blocks: int, centres: np.ndarray, scale: int
) -> dict:
    """A block of anchors as arrays; it has ``ANCHOR_BLOCK`` of them at most on average."""
    rows = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
    q = _whole(rows.column("x").combine_chunks(), scale)
    angle, size = _angles(q, centres)
    n = rows.num_rows
    return {
        "row": rows.column("row").to_numpy(), "label": rows.column("label").to_numpy(),
        "id": rows.column("id").to_pylist(), "q": q, "size": size,
        "cluster": angle.argmin(axis=1) if n else np.zeros(0, int),
        "floor": np.full(n, -np.inf),
    }


def _cones(anchors: DataFrame, centres: np.ndarray, scale: int) -> np.ndarray:
    """The widest angle between a centre and an anchor that is nearest to it."""

    def run(batches):
        for batch in batches:
            angle, _ = _angles(_whole(batch.column("x"), scale), centres)
            near = angle.argmin(axis=1)
            widest = angle[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(near, pa.int64()), pa.array(widest, pa.float64())], names=["c", "angle"]
            )

    wide = anchors.select("x").mapInArrow(run, "c long, angle double")
    out = np.zeros(len(centres))
    for c, angle in wide.groupBy("c").agg(F.max("angle")).collect():
        out[c] = angle
    return out


_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


def _mined(
    listed: DataFrame, head: DataFrame | None, block: dict, lists: int, positives: int,
    negatives: int, percent: int,
) -> DataFrame:
    """The result rows of one block of anchors. What comes back to the driver is at most
    ``positives`` rows for each of its anchors."""

    def found(chunks: DataFrame) -> DataFrame:
        rows = chunks.mapInArrow(
            _positives(block, lists, positives), "anchor long, score long, id long, row long"
        )
        return _ranked(rows, ["anchor"], positives)

    def under(chunks: DataFrame, wanted: dict) -> DataFrame:
        rows = chunks.mapInArrow(
            _negatives(block, wanted, lists, negatives, percent),
            "anchor long, positive long, score long, id long, row long",
        )
        return _ranked(rows, ["anchor", "positive"], negatives)

    if head is not None:
        for r in found(head).where(F.col("rank") == positives).select("anchor", "score").collect():
            block["floor"][r.anchor] = r.score
    best = stage_table(found(listed), "positives")
    n = len(block["row"])
    wanted = {
        "score": np.full((n, positives), _NONE), "floor": np.full((n, positives), -np.inf)
    }
    for r in best.select("anchor", "rank", "score").collect():
        wanted["score"][r.anchor, r.rank - 1] = r.score
    if head is not None:
        last = under(head, wanted).where(F.col("rank") == negatives)
        for r in last.select("anchor", "positive", "score").collect():
            wanted["floor"][r.anchor, r.positive] = r.score
    named = best.sparkSession.createDataFrame(
        pa.table({"anchor": pa.array(range(n), pa.int64()), "anchor_id": pa.array(block["id"], pa.int64())})
    )
    best = best.join(F.broadcast(named), "anchor").select(
        "anchor", "anchor_id", (F.col("rank") - 1).cast("long").alias("positive"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    mined = under(listed, wanted).select(
        "anchor", "positive", "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return mined.join(F.broadcast(best), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(
    rows: DataFrame, row_id: str, vector: str, label: Column, anchor: Column, *,
    positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT,
    scale: int = SCALE, clusters: int = CLUSTERS, chunk: int = CHUNK,
    anchor_block: int = ANCHOR_BLOCK, head_chunks: int = HEAD_CHUNKS,
) -> DataFrame:
    """For each anchor and each of its best ``positives`` rows of the same label, the best
    ``negatives`` rows of other labels that score no more than the positive and at least
    ``percent`` hundredths of it.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    if chunk > CHUNK:
        raise ValueError(f"a chunk has at most {CHUNK} rows")
    taken = taking_part(rows, row_id, vector, label, anchor)
    # Numbered once and written: later reads see the same numbers.
    taken = stage_table(taken.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    anchors = taken.where("anchor")
    n_anchors = anchors.count()
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], _RESULT)
    # Ranks are drawn by a hash, and so are blocks: both hold about their share of any order.
    drawn = F.pmod(F.xxhash64("row"), F.lit(n_anchors)) < 2 * SAMPLE
    sample = anchors.where(drawn).limit(2 * SAMPLE).select("x").toArrow()
    if not sample.num_rows:
        sample = anchors.limit(1).select("x").toArrow()
    centres = find_centres(_whole(sample.column("x").combine_chunks(), scale), clusters)
    cones = _cones(anchors, centres, scale)
    packed = "rows binary, n int, ids binary, nulls binary, labels binary, q binary, small boolean"
    listed = (
        taken.select("row", "id", "label", "x").mapInArrow(_chunks(scale, chunk), packed)
        .mapInArrow(_lists(centres, cones), f"{packed}, places binary, bounds binary")
    )
    listed = stage_table(listed, "candidate_lists")
    n_chunks = listed.count()
    head = None
    if n_chunks > 2 * head_chunks:
        head = listed.where(F.pmod(F.xxhash64("rows"), F.lit(n_chunks)) < head_chunks)
    blocks = -(-n_anchors // anchor_block)
    out = None
    for b in range(blocks):
        block = _anchor_block(anchors, b, blocks, centres, scale)
        part = _mined(listed, head, block, len(centres), positives, negatives, percent)
        part = stage_table(part, "hard_negatives")
        out = part if out is None else out.unionByName(part)
    return out
