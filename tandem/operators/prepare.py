"""Data-set preparation: cleaning, deduplication, features, splits, leak checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.sizing import pin_small

# Each split ticket starts with 4 hex digits, so there are at most 65,536 buckets
# per class, whatever the number of rows.
_BUCKET_HEX = 4


def drop_missing(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(~tx.is_missing(F.col(text)))


def keep_first(df: DataFrame, key, order: str) -> DataFrame:
    """Keep, for each key, the row with the lowest ``order`` value.

    ``order`` must be unique. Only (digest, order) pairs are grouped, with partial
    aggregation before the shuffle, so a key shared by a third of all rows costs one
    row per task. The full rows move once, in a join on the unique ``order``.
    """
    first = (
        df.select(F.sha2(key, 256).alias("_digest"), F.col(order))
        .groupBy("_digest")
        .agg(F.min(order).alias(order))
        .select(order)
    )
    return df.join(first, order, "left_semi")


def clean(df: DataFrame, row_id: str = "row_id", text: str = "text") -> DataFrame:
    """Drop missing texts, normalise, then keep the first of each case-folded text."""
    normal = drop_missing(df, text).withColumn(text, tx.normalize(F.col(text)))
    return keep_first(normal, tx.casefold(F.col(text)), row_id)


def text_features(
    df: DataFrame, text: str = "text", lexicon=tx.TECH_WORDS, unit: str = "ans"
) -> DataFrame:
    t = F.col(text)
    return df.withColumns(
        {
            "n_chars": F.length(t),
            "n_words": tx.n_words(t),
            "years_exp": tx.years_before(t, unit),
            "n_tech_words": tx.lexicon_count(t, lexicon),
        }
    )


def _ticket(row_id: str, seed: int):
    """Position of a row in the shuffled order of its class."""
    rid = F.col(row_id).cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}|"), rid)), F.lit("|"), rid)


def stratified_cuts(
    df: DataFrame,
    label: str,
    row_id: str,
    parts: list[tuple[str, int, int]],
    seed: int = 42,
) -> DataFrame:
    """Last ticket of each part, per class: one row per class.

    ``parts`` lists (name, numerator, denominator) of cumulative shares; a class of n
    rows gives its first ``round(n * numerator / denominator)`` tickets to the part.
    A bounded histogram of ticket prefixes finds the bucket that holds each cut, and
    only the rows of those buckets are ranked.
    """
    tickets = df.select(F.col(label), _ticket(row_id, seed).alias("_t")).withColumn(
        "_b", F.substring("_t", 1, _BUCKET_HEX)
    )
    hist = tickets.groupBy(label, "_b").agg(F.count("*").alias("_c"))
    by_label = Window.partitionBy(label)
    run = hist.withColumns(
        {
            "_n": F.sum("_c").over(by_label),
            "_upto": F.sum("_c").over(
                by_label.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(name).alias("part"),
                F.expr(f"(2 * {num} * _n + {den}) div (2 * {den})").alias("rank"),
            )
            for name, num, den in parts
        ]
    )
    targets = (
        run.withColumn("_p", F.explode(ranks))
        .where(
            (F.col("_p.rank") > F.col("_upto") - F.col("_c"))
            & (F.col("_p.rank") <= F.col("_upto"))
        )
        .select(
            label,
            "_b",
            F.col("_p.part").alias("part"),
            (F.col("_p.rank") - F.col("_upto") + F.col("_c")).alias("_k"),
        )
    )
    pinned = pin_small(targets)
    targets = targets if pinned is None else pinned
    in_bucket = Window.partitionBy(label, "part").orderBy("_t")
    cuts = (
        tickets.join(targets, [label, "_b"])
        .withColumn("_r", F.row_number().over(in_bucket))
        .where(F.col("_r") == F.col("_k"))
        .groupBy(label)
        .pivot("part", [name for name, _, _ in parts])
        .agg(F.first("_t"))
    )
    return cuts


def split(
    df: DataFrame,
    label: str,
    row_id: str,
    parts: list[tuple[str, int, int]],
    rest: str,
    seed: int = 42,
) -> DataFrame:
    """Add a ``split`` column: stratified, exact per class, the same on every run.

    The data rows do not move: each compares its own ticket with the cuts of its
    class. With more classes than a pinned table holds, the join shuffles instead.
    """
    cuts = stratified_cuts(df, label, row_id, parts, seed)
    renamed = cuts.select(
        label, *[F.col(name).alias(f"_cut_{name}") for name, _, _ in parts]
    )
    pinned = pin_small(renamed)
    out = df.withColumn("_t", _ticket(row_id, seed)).join(
        renamed if pinned is None else pinned, label, "left"
    )
    side = F.lit(rest)
    for name, _, _ in reversed(parts):
        side = F.when(F.col("_t") <= F.col(f"_cut_{name}"), F.lit(name)).otherwise(side)
    return out.withColumn("split", side).drop(
        "_t", *[f"_cut_{name}" for name, _, _ in parts]
    )


def split_60_20_20(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    return split(df, label, row_id, [("test", 1, 5), ("val", 2, 5)], "train", seed)


def holdout_75_25(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    return split(df, label, row_id, [("test", 1, 4)], "train", seed)


def leak_counts(df: DataFrame, text: str = "text", side: str = "split") -> DataFrame:
    """Distinct normalised texts found in both sides of each pair of splits.

    One pass: each text is reduced to the set of sides it occurs in.
    """
    key = F.sha2(tx.casefold(tx.normalize(F.col(text))), 256)
    sides = df.groupBy(key.alias("_key")).agg(
        *[
            F.max((F.col(side) == s).cast("int")).alias(s)
            for s in ("train", "val", "test")
        ]
    )
    both = lambda a, b: F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("bigint")
    return sides.agg(
        both("train", "val").alias("train_val"),
        both("train", "test").alias("train_test"),
        both("val", "test").alias("val_test"),
    )


def class_balance(raw: DataFrame, kept: DataFrame, label: str = "label") -> DataFrame:
    """Rows before and after cleaning and the share of positives left."""
    n_raw = raw.agg(F.count("*")).scalar()
    return kept.agg(
        n_raw.alias("n_raw"),
        F.count("*").alias("n_clean"),
        (n_raw - F.count("*")).alias("n_removed"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )
