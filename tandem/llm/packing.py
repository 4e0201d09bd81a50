"""Packing of token sequences by multiway differencing.

The ids of each document fill whole windows first. What is left over, less than a window, is
packed in blocks of at most ``BLOCK`` rests of one partition of the input, so no row moves.
Differencing keeps partial partitions of a block, each a tuple of window loads, and always
merges the two with the widest spread, the heaviest loads of one with the lightest of the
other. In the end one partition with nearly equal loads is left. If its heaviest load is
more than a window holds, the number of windows rises and the block is partitioned anew.

A few rests are cut into small pieces before, ``FILLERS`` to a window, which let the loads
come out so even that the least possible number of windows nearly always does.

Defined results: a null or empty text is a document of the end id alone. Each id of each row
lies in exactly one piece; repeated rows are packed as often as they come. Sequence numbers
are made of the partition's number and a count in it, so they are unique and come out the
same when a task is run again.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import bpe

WINDOW = 2048
END_ID = 1
#: Rests packed together.
BLOCK = 1024
#: Small pieces cut for each window, and their sizes in turn.
FILLERS = 4
FILLER_SIZES = (64, 32, 16, 8, 4, 2, 1)

SCHEMA = (
    "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal items to ``windows`` nearly equal loads: the window of each item, the loads."""
    # A partition is its loads, heaviest first and empty ones left out, with a node for
    # each load; nodes join in a tree whose leaves are the items.
    joined: list[tuple[int, int]] = []
    heap = []
    for i, size in enumerate(sizes.tolist()):
        spread = size if windows > 1 else 0
        heap.append((-spread, i, np.array([size]), np.array([i])))
    heapq.heapify(heap)
    serial = n = len(sizes)
    while len(heap) > 1:
        _, _, a, a_node = heapq.heappop(heap)
        _, _, b, b_node = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:
            # The lightest loads of a meet the lightest of b in opposite order.
            load = a[len(a) - over :] + b[::-1][: over] if over <= len(b) else None
            if load is None:
                raise AssertionError("loads outnumber windows")
            nodes = []
            for x, y in zip(a_node[len(a) - over :].tolist(), b_node[::-1][:over].tolist()):
                joined.append((x, y))
                nodes.append(n + len(joined) - 1)
            loads = np.concatenate([a[: len(a) - over], load, b[: len(b) - over]])
            node = np.concatenate([a_node[: len(a) - over], nodes, b_node[: len(b) - over]])
        else:
            loads, node = np.concatenate([a, b]), np.concatenate([a_node, b_node])
        order = np.argsort(-loads, kind="stable")
        loads, node = loads[order], node[order].astype(np.int64)
        low = loads[-1] if len(loads) == windows else 0
        heapq.heappush(heap, (-int(loads[0] - low), serial, loads, node))
        serial += 1
    _, _, loads, node = heap[0]
    window = np.empty(n + len(joined), dtype=np.int64)
    window[node] = np.arange(len(node))
    for at in range(len(joined) - 1, -1, -1):
        for part in joined[at]:
            window[part] = window[n + at]
    return window[:n], loads


def with_fillers(sizes: np.ndarray, windows: int) -> list[tuple[int, int, int]]:
    """Items as (rest, start, length): some rests cut into small pieces, the others whole."""
    budget = FILLERS * windows
    out, k = [], 0
    # The longest rests are the ones that fit worst.
    cut = set(np.argsort(-sizes, kind="stable")[: max(1, budget // 16)].tolist())
    for i, size in enumerate(sizes.tolist()):
        at = 0
        while i in cut and budget > 0 and at < size:
            take = min(FILLER_SIZES[k % len(FILLER_SIZES)], size - at)
            out.append((i, at, take))
            at, k, budget = at + take, k + 1, budget - 1
        if at < size:
            out.append((i, at, size - at))
    return out


def pack(sizes: np.ndarray, window: int = WINDOW) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Items (rest, start, length) and the window of each; no window is overfull."""
    windows = max(1, -(-int(sizes.sum()) // window))
    items = with_fillers(sizes, windows) if windows > 1 else [
        (i, 0, s) for i, s in enumerate(sizes.tolist())
    ]
    lengths = np.array([x[2] for x in items], dtype=np.int64)
    while True:
        at, loads = difference(lengths, windows)
        if loads.max() <= window:
            return items, at
        windows += 1


def _pack_partition(path: str, window: int, block: int):
    def run(batches):
        base = TaskContext.get().partitionId() << 33
        serial = 0
        rests: list[tuple] = []
        rows: list[tuple] = []
        kind = None

        def piece(doc, start, ids, n, sequence, offset):
            crc = zlib.crc32(ids.tobytes())
            rows.append((doc, start, len(ids), crc, n, base + sequence, offset))

        def flush():
            nonlocal serial
            items, at = pack(np.array([len(r[2]) for r in rests]), window)
            filled: dict[int, int] = {}
            for (i, start, length), w in zip(items, at.tolist()):
                doc, first, ids, n = rests[i]
                offset = filled.get(w, 0)
                filled[w] = offset + length
                piece(doc, first + start, ids[start : start + length], n, serial + w, offset)
            serial += max(filled) + 1
            rests.clear()

        def table():
            columns = list(zip(*rows))
            rows.clear()
            types = [kind] + [pa.int64()] * 6
            names = [f.split()[0] for f in SCHEMA.format(kind="").split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

        for batch in batches:
            encoder = bpe.encoder(path)
            kind = batch.column("doc_id").type
            docs = batch.column("doc_id").to_pylist()
            for doc, text in zip(docs, batch.column("text")):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                full = len(ids) // window * window
                for start in range(0, full, window):
                    piece(doc, start, ids[start : start + window], len(ids), serial, 0)
                    serial += 1
                if full < len(ids):
                    rests.append((doc, full, ids[full:], len(ids)))
                if len(rests) >= block:
                    flush()
                if len(rows) >= 4096:
                    yield table()
        if rests:
            flush()
        if rows:
            yield table()

    return run


def packed(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text) in sequences of ``window`` ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_pack_partition(tokenizer, window, block), SCHEMA.format(kind=kind))
