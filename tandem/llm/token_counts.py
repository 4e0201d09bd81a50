"""Token counts of whole texts, long ones in overlapping chunks.

A text longer than ``chunk`` characters is cut near each multiple of it. The chunks on
either side of a cut both read an overlap, each is encoded with byte offsets, and the counts
are spliced at a boundary that both encodings have and that is proven stable: its place
depends on the overlap's characters alone. An overlap without such a boundary is widened. A
cut at which the encodings do not agree would raise an error; none can by the proof.

Chunks of long texts are dealt out by text and chunk, so one huge document is encoded by
many tasks. Short texts are encoded where they are read.

Defined results: a null or empty text has no bytes and no tokens. Repeated rows each get a
row. Ids and texts are the only columns read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe

MAX_TOKENS = 1024


def _whole(path: str):
    def run(batches):
        for batch in batches:
            encoder = bpe.encoder(path)
            n = [len(encoder.encode(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def _cut(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                parts = bpe.chunks(batch.column("text")[row].as_py(), chunk, overlap)
                texts, low, high = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(c)[row].as_py()] * len(parts), batch.column(c).type)
                        for c in ("row", "doc_id", "n_bytes")
                    ]
                    + [
                        pa.array(range(len(parts)), pa.int32()), pa.array(texts),
                        pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                    ],
                    names=["row", "doc_id", "n_bytes", "part", "text", "low", "high"],
                )

    return run


def _spliced(path: str):
    def run(batches):
        for batch in batches:
            encoder = bpe.encoder(path)
            cells = (batch.column(c).to_pylist() for c in ("text", "low", "high"))
            n = [encoder.count_between(t, a, b) for t, a, b in zip(*cells)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "doc_id", "n_bytes")] + [pa.array(n, pa.int64())],
                names=["row", "doc_id", "n_bytes", "n"],
            )

    return run


def token_counts(
    docs: DataFrame, tokenizer: str, chunk: int = bpe.CHUNK, overlap: int = bpe.OVERLAP,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file (.json), the same on all machines.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = rows.where(F.length("text") <= chunk).mapInArrow(
        _whole(tokenizer), f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    long = rows.withColumn("row", F.monotonically_increasing_id()).where(F.length("text") > chunk)
    parts = long.mapInArrow(
        _cut(chunk, overlap),
        f"row long, doc_id {kind}, n_bytes long, part int, text string, low long, high long",
    ).repartition("row", "part")
    counted = (
        parts.mapInArrow(_spliced(tokenizer), f"row long, doc_id {kind}, n_bytes long, n long")
        .groupBy("row", "doc_id", "n_bytes")
        .agg(F.sum("n").alias("n_tokens"))
        .drop("row")
    )
    return short.unionByName(counted).withColumn("over_limit", F.col("n_tokens") > max_tokens)
