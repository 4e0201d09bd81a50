"""Quality gates: data, model and safety verdicts, one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .privacy import leak_report


def _percent(x, digits: int):
    return F.concat(F.format_number(x * 100, digits), F.lit("%"))


def data_gate(
    df: DataFrame,
    features: list[str],
    label: str,
    min_rows: int = 200,
    positive_range: tuple[float, float] = (0.02, 0.5),
) -> DataFrame:
    """Size, missing values, class balance: the first failure gives the reason."""
    low, high = positive_range
    hole = F.lit(False)
    for f in features:
        c = F.col(f).cast("double")
        hole = hole | c.isNull() | F.isnan(c)
    n, rate = F.col("_n"), F.col("_rate")
    stats = df.agg(
        F.count("*").alias("_n"),
        F.count_if(hole).alias("_holes"),
        F.avg(F.col(label).cast("double")).alias("_rate"),
    )
    shown = n.cast("string")
    fail_small = n < min_rows
    fail_hole = F.col("_holes") > 0
    fail_rate = F.coalesce((rate < low) | (rate > high), F.lit(True))
    reason = (
        F.when(fail_small, F.concat(shown, F.lit(f" lignes < minimum {min_rows}")))
        .when(fail_hole, F.lit("valeurs manquantes dans les features"))
        .when(
            fail_rate,
            F.concat(
                F.lit("taux de positifs "), _percent(rate, 1),
                F.lit(f" hors bornes [{low:.0%}, {high:.0%}]"),
            ),
        )
        .otherwise(
            F.concat(shown, F.lit(" lignes, "), _percent(rate, 1), F.lit(" de positifs"))
        )
    )
    return stats.select(
        F.lit("data_gate").alias("name"),
        (~(fail_small | fail_hole | fail_rate)).alias("passed"),
        reason.alias("reason"),
    )


def model_gate(
    metrics: DataFrame, metric: str = "recall", tolerance: float = 0.02
) -> DataFrame:
    """Champion against challenger on one metric of ``metrics(role, metric, value)``."""
    pick = lambda role: F.max(F.when(F.col("role") == role, F.col("value")))
    pair = metrics.where(F.col("metric") == metric).agg(
        pick("challenger").alias("new"), pick("champion").alias("old")
    )
    new, old = F.col("new"), F.col("old")
    show = lambda c: F.format_number(c, 3)
    fails = F.coalesce(new < old - F.lit(tolerance), F.lit(True))
    reason = F.when(
        fails,
        F.concat(
            F.lit(f"{metric} du challenger "), show(new), F.lit(" < champion "), show(old),
            F.lit(f" (tolérance {tolerance})"),
        ),
    ).otherwise(
        F.concat(
            F.lit(f"{metric} : challenger "), show(new), F.lit(" vs champion "), show(old)
        )
    )
    return pair.select(
        F.lit("model_gate").alias("name"), (~fails).alias("passed"), reason.alias("reason")
    )


def safety_gate(
    df: DataFrame, pos: str, text: str = "text", declared: bool = True
) -> DataFrame:
    """No text may leak personal data; the first leaking position is named.

    Positions count from 0 and are reported from 1. Only one row per task travels.
    """
    found = leak_report(df, text, declared).select(
        pos, F.array_sort(F.array_distinct("leaks")).alias("_l")
    )
    agg = found.agg(
        F.count("*").alias("_n"),
        F.min_by(
            F.when(F.size("_l") > 0, F.struct(F.col(pos).alias("p"), F.col("_l").alias("l"))),
            F.when(F.size("_l") > 0, F.col(pos)),
        ).alias("_first"),
    )
    first = F.col("_first")
    reason = F.when(
        first.isNull(),
        F.concat(F.col("_n").cast("string"), F.lit(" sorties inspectées, zéro fuite")),
    ).otherwise(
        F.concat(
            F.lit("fuite PII dans la sortie "), (first["p"] + 1).cast("string"),
            F.lit(" : ["), F.array_join(first["l"], ", "), F.lit("]"),
        )
    )
    return agg.select(
        F.lit("safety_gate").alias("name"), first.isNull().alias("passed"),
        reason.alias("reason"),
    )


def report_line(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "line",
        F.concat(
            F.when(F.col("passed"), "[PASS] ").otherwise("[FAIL] "),
            F.col("name"), F.lit(" — "), F.col("reason"),
        ),
    )


def run_gates(results: DataFrame) -> DataFrame:
    """Overall verdict: every gate must pass; no gate at all passes."""
    return results.agg(
        F.count("*").alias("gates"),
        F.coalesce(F.every("passed"), F.lit(True)).alias("passed"),
    )
