"""Exact dense retrieval over clustered vectors that skips clusters it need not read.

Directions are packed in blocks by cluster, a centre each with the distance of its farthest
member. A query first meets the cluster whose centre is nearest; its k-th score there is the
least that others must offer. By the triangle inequality no member of a cluster is closer
than the distance to the centre less the radius, so the clusters, and within the others the
blocks, whose best possible score is below that are skipped. Queries are rows like the
vectors: both meet in a join by cluster, and no number of queries gathers anywhere.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.skew import heavy_keys, salted_join
from ..plans.staging import stage_table

# Clusters, and vectors sampled to find their centres.
CLUSTERS, SAMPLE = 64, 8_192
# Vectors of a packed block and queries of one; rows that a task holds while it packs.
BLOCK, QUERY_BLOCK, HELD = 4_096, 512, 65_536
# Scores are compared to nine digits; what differs by less is not skipped.
SLACK = 3e-9


def unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return unit(flat.reshape(len(column), -1))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T
    return np.sqrt(np.maximum(square, 0))


def find_centres(x: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(0)
    centres = x[rng.choice(len(x), min(clusters, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    return centres


@dataclass
class Index:
    """``blocks``: cluster, n, ids, x, far. ``radius`` by cluster, negative for an empty one."""

    blocks: DataFrame
    centres: np.ndarray
    radius: np.ndarray


def build_index(
    vectors: DataFrame, doc: str, vector: str, clusters: int = CLUSTERS, block: int = BLOCK
) -> Index | None:
    """Vectors in packed blocks by cluster; None if there are none."""
    rows = vectors.where(F.col(vector).isNotNull()).select(
        F.col(doc).alias("doc"), F.transform(vector, lambda v: v.cast("double")).alias("x")
    )
    n = rows.count()
    if not n:
        return None
    drawn = rows.where(F.pmod(F.xxhash64("doc"), F.lit(n)) < 2 * SAMPLE).limit(2 * SAMPLE)
    sample = drawn.select("x").toArrow() if n > SAMPLE else rows.select("x").toArrow()
    centres = find_centres(_matrix(sample.column("x").combine_chunks()), min(clusters, max(1, n // 32)))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches):
        held, n_held = defaultdict(list), 0

        def packed(c):
            ids = pa.concat_arrays([i for i, _ in held[c]])
            x = np.concatenate([m for _, m in held.pop(c)])
            far = float(_distances(x, centres[c : c + 1]).max())
            ids = pa.ListArray.from_arrays([0, len(ids)], ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([len(x)], pa.int32()), ids,
                 pa.array([x.tobytes()], pa.binary()), pa.array([far])],
                names=["cluster", "n", "ids", "x", "far"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            near = _distances(x, centres).argmin(axis=1)
            for c in np.unique(near).tolist():
                of_c = np.flatnonzero(near == c)
                for at in range(0, len(of_c), block):
                    part = of_c[at : at + block]
                    held[c].append((batch.column("doc").take(pa.array(part)), x[part]))
                n_held += len(of_c)
                if sum(len(m) for _, m in held[c]) >= block:
                    n_held -= sum(len(m) for _, m in held[c])
                    yield packed(c)
            while n_held > HELD:
                c = max(held, key=lambda c: sum(len(m) for _, m in held[c]))
                n_held -= sum(len(m) for _, m in held[c])
                yield packed(c)
        for c in list(held):
            yield packed(c)

    blocks = stage_table(
        rows.mapInArrow(run, f"cluster int, n int, ids array<{kind}>, x binary, far double"),
        "dense_blocks",
    )
    radius = np.full(len(centres), -1.0)
    for c, far in blocks.groupBy("cluster").agg(F.max("far")).collect():
        radius[c] = far
    return Index(blocks, centres, radius)


def best_possible(q: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By query and cluster: no member scores more."""
    least = np.maximum(_distances(q, centres) - radius[None, :] - 1e-9, 0)
    return np.where(radius[None, :] < 0, -np.inf, 1 - least * least / 2)


def _deal(index: Index, first: bool):
    """Queries in packed blocks: at the nearest cluster, or at all others that may have more
    than their ``least`` score."""
    centres, radius = index.centres, index.radius

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("x"))
            away = np.where(radius[None, :] < 0, np.inf, _distances(q, centres))
            home = away.argmin(axis=1)
            if first:
                wanted = np.zeros(away.shape, dtype=bool)
                wanted[np.arange(len(q)), home] = True
                least = np.full(len(q), -np.inf)
            else:
                least = batch.column("least").to_numpy(zero_copy_only=False)
                wanted = best_possible(q, centres, radius) >= least[:, None] - SLACK
                wanted[np.arange(len(q)), home] = False
            for c in np.flatnonzero(wanted.any(axis=0)).tolist():
                some = np.flatnonzero(wanted[:, c])
                for at in range(0, len(some), QUERY_BLOCK):
                    part = some[at : at + QUERY_BLOCK]
                    ids = batch.column("query").take(pa.array(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], pa.int32()), pa.ListArray.from_arrays([0, len(ids)], ids),
                         pa.array([q[part].tobytes()], pa.binary()), pa.array([least[part].tobytes()], pa.binary())],
                        names=["cluster", "queries", "q", "least"],
                    )

    return run


def _scores(k: int, centres: np.ndarray):
    def run(batches):
        for batch in batches:
            queries, docs = batch.column("queries"), batch.column("ids")
            for i in range(batch.num_rows):
                names, ids = queries[i].values, docs[i].values
                least = np.frombuffer(batch.column("least")[i].as_py())
                q = np.frombuffer(batch.column("q")[i].as_py()).reshape(len(names), -1)
                x = np.frombuffer(batch.column("x")[i].as_py()).reshape(len(ids), -1)
                c, far = batch.column("cluster")[i].as_py(), batch.column("far")[i].as_py()
                live = np.flatnonzero(
                    best_possible(q, centres[c : c + 1], np.array([far]))[:, 0] >= least - SLACK
                )
                if not len(live):
                    continue
                s = np.round(q[live] @ x.T, 12)
                listed = ids.to_pylist()
                rank = np.empty(len(listed), dtype=np.int64)
                rank[sorted(range(len(listed)), key=lambda j: (listed[j] is not None, listed[j]))] = np.arange(len(listed))
                top = [np.lexsort((rank, -np.round(row, 9)))[:k] for row in s]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(np.repeat(live, [len(t) for t in top]))),
                        ids.take(pa.array(np.concatenate(top))),
                        pa.array(np.concatenate([s[j, t] for j, t in enumerate(top)])),
                    ],
                    names=["query", "doc", "score"],
                )

    return run


def _met(index: Index, dealt: DataFrame, k: int, kinds: str) -> DataFrame:
    """Best k of each query and block of its clusters."""
    blocks = index.blocks.withColumn("block", F.xxhash64("ids"))
    dealt = stage_table(dealt, "dense_queries")
    sizes = index.blocks.groupBy("cluster").agg(F.count("*").alias("m"))
    heavy = heavy_keys(sizes, "cluster", "m")
    pairs = salted_join(blocks, dealt, "cluster", heavy, F.col("block"))
    return pairs.select("cluster", "far", "ids", "x", "queries", "q", "least").mapInArrow(
        _scores(k, index.centres), kinds
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.round("score", 9).desc(), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dense_topk(
    vectors: DataFrame, queries: DataFrame, k: int = 3, doc: str = "vec_id",
    vector: str = "embedding", query_id: str = "query_id", clusters: int = CLUSTERS,
) -> DataFrame:
    """Exact cosine top-k over ``ARRAY<FLOAT>`` columns: (query, doc, score, rank).

    A vector of zeros scores zero; rows without a vector take no part. Ties of nine digits go
    to the smaller ``doc``.
    """
    doc_type = vectors.schema[doc].dataType.simpleString()
    qid_type = queries.schema[query_id].dataType.simpleString()
    kinds = f"query {qid_type}, doc {doc_type}, score double"
    index = build_index(vectors, doc, vector, clusters)
    if index is None:
        empty = vectors.sparkSession.createDataFrame([], f"{kinds}, rank int")
        return empty.withColumnsRenamed({"query": query_id, "doc": doc})
    asked, first = _first_round(index, queries, k, vector, query_id, kinds)
    rest = asked.mapInArrow(_deal(index, False), _dealt(qid_type))
    found = first.drop("rank").unionByName(_met(index, rest, k, kinds))
    return _best(found, k).withColumnsRenamed({"query": query_id, "doc": doc})


def _dealt(qid_type: str) -> str:
    return f"cluster int, queries array<{qid_type}>, q binary, least binary"


def _first_round(index: Index, queries: DataFrame, k: int, vector: str, query_id: str, kinds: str):
    """Queries (query, x, least) with the k-th score of their nearest cluster, and its rows."""
    asked = stage_table(
        queries.where(F.col(vector).isNotNull()).select(
            F.col(query_id).alias("query"),
            F.transform(vector, lambda v: v.cast("double")).alias("x"),
        ),
        "asked",
    )
    qid_type = asked.schema["query"].dataType.simpleString()
    dealt = asked.mapInArrow(_deal(index, True), _dealt(qid_type))
    first = stage_table(_best(_met(index, dealt, k, kinds), k), "nearest_clusters")
    least = first.where(F.col("rank") == k).select("query", F.col("score").alias("least"))
    asked = asked.join(least, "query", "left").withColumn(
        "least", F.coalesce("least", F.lit(float("-inf")))
    )
    return asked, first


def skipped(
    vectors: DataFrame, queries: DataFrame, k: int = 3, doc: str = "vec_id",
    vector: str = "embedding", query_id: str = "query_id", clusters: int = CLUSTERS,
) -> DataFrame:
    """What a search leaves out: (query, n_clusters, n_skipped, n_vectors, vectors_skipped)."""
    doc_type = vectors.schema[doc].dataType.simpleString()
    qid_type = queries.schema[query_id].dataType.simpleString()
    index = build_index(vectors, doc, vector, clusters)
    asked, _ = _first_round(
        index, queries, k, vector, query_id, f"query {qid_type}, doc {doc_type}, score double"
    )
    sizes = np.zeros(len(index.centres), dtype=np.int64)
    for c, n in index.blocks.groupBy("cluster").agg(F.sum("n")).collect():
        sizes[c] = n
    centres, radius = index.centres, index.radius

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("x"))
            least = batch.column("least").to_numpy(zero_copy_only=False)
            read = best_possible(q, centres, radius) >= least[:, None] - SLACK
            read[np.arange(len(q)), np.where(radius < 0, np.inf, _distances(q, centres)).argmin(axis=1)] = True
            n = int((radius >= 0).sum())
            count = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), count([n] * len(q)), count(n - read.sum(axis=1)),
                 count([int(sizes.sum())] * len(q)), count(sizes.sum() - read @ sizes)],
                names=["query", "n_clusters", "n_skipped", "n_vectors", "vectors_skipped"],
            )

    out = f"query {qid_type}, n_clusters long, n_skipped long, n_vectors long, vectors_skipped long"
    return asked.mapInArrow(run, out).withColumnRenamed("query", query_id)
