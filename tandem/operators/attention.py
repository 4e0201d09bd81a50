"""Grouped softmax and single-head self-attention over table rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binding import computed
from ..plans.skew import heavy_keys, lookup, salted_join
from ..plans.staging import stage_table

# Positions per block: the most rows any array of the attention join holds.
BLOCK = 128


def group_softmax(
    df: DataFrame, group: str, score: str, row_id: str, output: str = "softmax"
) -> DataFrame:
    """``exp(s - max) / sum(exp(s - max))`` within each group.

    The group maximum and then the sum are partial aggregates attached to the rows by
    a lookup, so a group that holds a large share of the rows is never gathered.
    """
    spread = F.col(row_id)
    top = stage_table(
        df.groupBy(group).agg(F.max(score).alias("_max"), F.count("*").alias("_n")), "max"
    )
    shifted = lambda rows, table: lookup(rows, table, group, spread, table, "_n").withColumn(
        "_e", F.exp(F.col(score) - F.col("_max"))
    )
    total = stage_table(
        shifted(df.select(group, score, row_id), top)
        .groupBy(group)
        .agg(F.first("_max").alias("_max"), F.first("_n").alias("_n"), F.sum("_e").alias("_z")),
        "sum",
    )
    return (
        shifted(df, total)
        .withColumn(output, F.col("_e") / F.col("_z"))
        .drop("_max", "_n", "_z", "_e")
    )


def _project(w_query, w_key, w_value):
    """Arrow function from an embedding to its query, key and value vectors."""
    mats = [np.asarray(w, dtype="float64") for w in (w_query, w_key, w_value)]

    @F.pandas_udf("q array<double>, k array<double>, v array<double>")
    def project(x: pd.Series) -> pd.DataFrame:
        m = np.stack(x.to_numpy()).astype("float64")
        return pd.DataFrame({n: list(m @ w) for n, w in zip("qkv", mats)})

    return project


def _block_attention(seq: str):
    """Attention of one block of queries over one block of keys, not yet normalised."""

    def frame(sid, block, pos, top, z, acc):
        n = len(top)
        return pd.DataFrame({seq: [sid] * n, "_p": pos, "_m": top, "_z": z, "_acc": list(acc)})

    def run(batches):
        held = None
        for pdf in batches:
            for sid, block, pos, q, k, v in zip(
                pdf[seq], pdf["_b"], pdf["_pos"], pdf["_q"], pdf["_k"], pdf["_v"]
            ):
                qm, km, vm = (np.stack(list(m)) for m in (q, k, v))
                s = qm @ km.T / np.sqrt(qm.shape[1])
                top = s.max(axis=1)
                e = np.exp(s - top[:, None])
                z, acc = e.sum(axis=1), e @ vm
                # A join gives the pairs of a query block one after another: they are merged here.
                if held is not None and held[:2] == (sid, block):
                    _, _, _, top0, z0, acc0 = held
                    new = np.maximum(top0, top)
                    a, b = np.exp(top0 - new), np.exp(top - new)
                    top, z, acc = new, z0 * a + z * b, acc0 * a[:, None] + acc * b[:, None]
                elif held is not None:
                    yield frame(*held)
                held = (sid, block, pos, top, z, acc)
        if held is not None:
            yield frame(*held)

    return run


# Sequences of fewer blocks have too few pairs to be worth splitting.
SPLIT_BLOCKS = 32


def block_pairs(blocks: DataFrame, seq: str) -> DataFrame:
    """Each block of queries beside each block of keys of its sequence.

    A long sequence has as many pairs as the square of its blocks: one that owns a share of
    all pairs is split by its query blocks.
    """
    queries = blocks.select(seq, "_b", F.col("_r.p").alias("_pos"), F.col("_r.q").alias("_q"))
    keys = blocks.select(seq, F.col("_r.k").alias("_k"), F.col("_r.v").alias("_v"))
    long = (
        blocks.groupBy(seq).agg(F.count("*").alias("_n")).where(F.col("_n") >= SPLIT_BLOCKS)
        .select(seq, (F.col("_n") * F.col("_n")).alias("_n"))
    )
    return salted_join(queries, keys, seq, heavy_keys(long, seq, "_n"), F.col("_b"))


def self_attention(
    df: DataFrame, seq: str, pos: str, vector: str, w_query, w_key, w_value
) -> DataFrame:
    """(seq, pos, output): softmax(Q K^T / sqrt(d)) V within each sequence.

    Positions are unique integers. Sequences are cut in blocks of at most BLOCK
    positions; blocks of queries meet blocks of keys, and partial results are merged
    with their running maxima, so sequences of any length come out exact while no
    array holds more than one block.
    """
    qkv = df.select(seq, pos, _project(w_query, w_key, w_value)(F.col(vector)).alias("_x"))
    blocks = stage_table(
        qkv.groupBy(seq, F.floor(F.col(pos) / BLOCK).alias("_b"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(F.col(pos).alias("p"), F.col("_x.q").alias("q"), F.col("_x.k").alias("k"), F.col("_x.v").alias("v"))
                )
            ).alias("_r")
        ),
        "attention-blocks",
    )
    seq_type = df.schema[seq].dataType.simpleString()
    pos_type = df.schema[pos].dataType.simpleString()
    parts = block_pairs(blocks, seq).mapInPandas(
        _block_attention(seq),
        f"{seq} {seq_type}, _p {pos_type}, _m double, _z double, _acc array<double>",
    )
    merged = parts.groupBy(seq, F.col("_p").alias(pos)).agg(
        F.max("_m").alias("_top"), F.collect_list(F.struct("_m", "_z", "_acc")).alias("_l")
    )
    scaled = F.transform(
        "_l",
        lambda s: F.struct(
            (s["_z"] * F.exp(s["_m"] - F.col("_top"))).alias("z"),
            F.transform(s["_acc"], lambda a: a * F.exp(s["_m"] - F.col("_top"))).alias("a"),
        ),
    )
    merged = computed(merged, {"_s": scaled})
    z = F.aggregate("_s", F.lit(0.0), lambda acc, s: acc + s["z"])
    total = F.aggregate(
        F.slice("_s", 2, F.size("_s")),
        F.col("_s")[0]["a"],
        lambda acc, s: F.zip_with(acc, s["a"], lambda x, y: x + y),
    )
    return computed(merged.select(seq, pos, "_s"), {"_z": z, "_a": total}).select(seq, pos, F.transform("_a", lambda x: x / F.col("_z")).alias("output"))
