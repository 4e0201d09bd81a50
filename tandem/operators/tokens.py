"""Token statistics and a vocabulary with dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.skew import frequent_lookup
from ..plans.staging import stage_table


def token_stats(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Texts, characters and tokens per group, and tokens per character."""
    t = F.col(text)
    return (
        df.select(by, F.length(t).alias("_c"), F.size(tx.pretokens(t)).alias("_t"))
        .groupBy(by)
        .agg(
            F.count("*").alias("n_texts"),
            F.sum("_c").alias("n_chars"),
            F.sum("_t").alias("n_tokens"),
        )
        .withColumn("tokens_per_char", F.try_divide("n_tokens", "n_chars"))
    )


def vocabulary(pieces: DataFrame, piece: str = "piece") -> DataFrame:
    """(piece, n, id) with ids 0..v-1 in hash order. Staged.

    Ids come from the row's place in its hash bucket plus the size of the buckets
    before it. There are 65,536 buckets, so only that bounded histogram is summed in
    one place; the pieces themselves are numbered bucket by bucket.
    """
    counted = stage_table(
        pieces.groupBy(piece)
        .agg(F.count("*").alias("n"))
        .withColumn("_h", F.md5(piece))
        .withColumn("_b", F.substring("_h", 1, 4)),
        "pieces",
    )
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy("_b")
        .agg(F.count("*").alias("_c"))
        .withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        .select("_b", "_off")
    )
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", piece)) - 1
    return stage_table(
        counted.withColumn("_p", place)
        .join(offsets, "_b")
        .select(piece, "n", (F.col("_p") + F.col("_off")).cast("bigint").alias("id")),
        "vocabulary",
    )


def encode(df: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """(doc, n_chars, n_tokens, ids): each text as vocabulary ids in reading order."""
    pieces = tx.pretokens(F.col(text))
    exploded = df.select(doc, F.posexplode(pieces).alias("_pos", "piece"))
    vocab = vocabulary(exploded)
    ids = (
        frequent_lookup(exploded, vocab, "piece", F.col(doc), "n")
        .groupBy(doc)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "id"))).alias("_l"))
    )
    sizes = df.select(doc, F.length(text).alias("n_chars"), F.size(pieces).alias("n_tokens"))
    return sizes.join(ids, doc, "left").select(
        doc,
        "n_chars",
        "n_tokens",
        F.coalesce(
            F.transform("_l", lambda s: s["id"]), F.array().cast("array<bigint>")
        ).alias("ids"),
    )
