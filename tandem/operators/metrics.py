"""Classification and group-fairness metrics, each from one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = "féminine?s?"


def counts(label: Column, pred: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if(~label & ~pred),
        "fp": F.count_if(~label & pred),
        "fn": F.count_if(label & ~pred),
        "tp": F.count_if(label & pred),
    }


def ratios(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1; a zero denominator gives 0."""
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return {
        "accuracy": div(tp + tn, tp + tn + fp + fn),
        "precision": div(tp, tp + fp),
        "recall": div(tp, tp + fn),
        "f1": div(2 * tp, 2 * tp + fp + fn),
    }


def confusion(df: DataFrame, label: str, pred: str, by: list[str] = ()) -> DataFrame:
    c = counts(F.col(label), F.col(pred))
    aggs = [v.alias(k) for k, v in c.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def binary_metrics(df: DataFrame, label: str, pred: str, by: list[str] = ()) -> DataFrame:
    base = confusion(df, label, pred, by)
    r = ratios(*[F.col(k) for k in ("tn", "fp", "fn", "tp")])
    return base.select(*by, *[v.alias(k) for k, v in r.items()])


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds=(0.3, 0.5, 0.7)
) -> DataFrame:
    """Precision and recall at each threshold; scores at the threshold count as yes.

    All thresholds are counted in the same pass, then the one row is unfolded.
    """
    y, p = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        yes = p >= F.lit(float(t))
        aggs += [
            F.count_if(y & yes).alias(f"tp{i}"),
            F.count_if(~y & yes).alias(f"fp{i}"),
            F.count_if(y & ~yes).alias(f"fn{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                F.col(f"fn{i}").alias("fn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    r = ratios(F.lit(0), F.col("fp"), F.col("fn"), F.col("tp"))
    return df.agg(*aggs).select(F.inline(rows)).select(
        "threshold", r["precision"].alias("precision"), r["recall"].alias("recall")
    )


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Metrics of a model that always answers the most frequent label."""
    n, pos = F.col("_n"), F.col("_pos")
    c = df.agg(F.count("*").alias("_n"), F.count_if(F.col(label)).alias("_pos"))
    yes = pos * 2 > n
    zero = F.lit(0)
    r = ratios(
        F.when(yes, zero).otherwise(n - pos),
        F.when(yes, n - pos).otherwise(zero),
        F.when(yes, zero).otherwise(pos),
        F.when(yes, pos).otherwise(zero),
    )
    return c.select(yes.alias("answer"), *[v.alias(k) for k, v in r.items()])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows over (number of classes times rows of the class)."""
    per = df.groupBy(label).agg(F.count("*").alias("n"))
    total = per.agg(F.sum("n")).scalar()
    classes = per.agg(F.count("*")).scalar()
    return per.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def group_rates(df: DataFrame, group: str, flag: Column, name: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(flag.cast("double")).alias(name))


def disparate_impact(
    df: DataFrame, group: str, flag: str, favoured: str, other: str
) -> DataFrame:
    """Ratio of the selection rates; 0 where the favoured group's rate is 0."""
    rate = lambda g: F.coalesce(
        F.avg(F.when(F.col(group) == g, F.col(flag).cast("double"))), F.lit(0.0)
    )
    return df.agg(rate(favoured).alias("rate_a"), rate(other).alias("rate_b")).select(
        "rate_a",
        "rate_b",
        F.when(F.col("rate_a") > 0, F.col("rate_b") / F.col("rate_a"))
        .otherwise(F.lit(0.0))
        .alias("impact"),
    ).withColumn("alarm", F.col("impact") < 0.8)


def has_marker(text: Column, marker: str = MARKER) -> Column:
    return text.rlike(rf"(?iuU)\b{marker}\b")


def neutralize(text: Column, marker: str = MARKER) -> Column:
    """Replace the marker by a space, then collapse white space."""
    from ..functions.text import collapse

    return collapse(F.regexp_replace(text, rf"(?iuU)\b{marker}\b", " "))
