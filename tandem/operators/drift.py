"""Population stability: exact decile edges, open-ended bins, PSI and its status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import pin_small

# Conventional PSI bounds and the floor of an empty bin's share.
WATCH = 0.1
ALERT = 0.2
FLOOR = 1e-4

# Status of a feature that one of the samples has no values of.
NO_REFERENCE = "no reference"
NO_PRODUCTION = "no production"

BINS = 10
# Rank error of the sketch that brackets each quantile is at most n / SKETCH.
SKETCH = 10_000


def unpivot(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Long form (keys, feature, value) of numeric columns."""
    return df.select(
        *keys, *[F.col(f).cast("double").alias(f) for f in features]
    ).unpivot(keys, features, "feature", "value")


def _probes(bins: int) -> list[float]:
    return [i / bins for i in range(1, bins)]


def quantile_edges(
    df: DataFrame, feature: str = "feature", value: str = "value", bins: int = BINS
) -> DataFrame:
    """Interior quantile edges per feature: (feature, n, edges), exact and linear.

    A quantile sketch with a guaranteed rank error brackets each quantile. One more
    pass counts the rows below every bracket and groups the few values inside; the
    exact order statistics follow from those. No task ever holds a whole column.
    """
    probes = _probes(bins)
    eps = 4.0 / SKETCH
    at = lambda qs: [min(max(q, 0.0), 1.0) for q in qs]
    x = df.where(F.col(value).isNotNull()).select(feature, F.col(value).alias("_v"))
    sketch = x.groupBy(feature).agg(
        F.count("*").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx(
            "_v", at([q - eps for q in probes] + [q + eps for q in probes]), SKETCH
        ).alias("_q"),
    ).withColumns(
        {
            "_lo": F.slice("_q", 1, len(probes)),
            "_hi": F.slice("_q", len(probes) + 1, len(probes)),
        }
    )
    # A bracket must also hold the next order statistic, which in a short column may
    # lie further away than the sketch error: there it is the whole range.
    short = F.col("n") <= 8 * SKETCH
    brackets = sketch.select(
        feature,
        "n",
        F.when(short, F.transform("_lo", lambda _: F.col("_min")))
        .otherwise(F.col("_lo"))
        .alias("lo"),
        F.when(short, F.transform("_hi", lambda _: F.col("_max")))
        .otherwise(F.col("_hi"))
        .alias("hi"),
    )
    pinned = pin_small(brackets)
    brackets = brackets if pinned is None else pinned
    at_bracket = x.join(brackets, feature)
    below = (
        at_bracket.groupBy(
            feature,
            F.size(F.filter("lo", lambda e: F.col("_v") >= e)).alias("_b"),
        )
        .agg(F.count("*").alias("_c"))
        .groupBy(feature)
        .agg(F.collect_list(F.struct("_b", "_c")).alias("_hist"))
    )
    inside = (
        at_bracket.withColumn("_in", F.arrays_zip("lo", "hi"))
        .where(
            F.exists("_in", lambda e: (F.col("_v") >= e["lo"]) & (F.col("_v") <= e["hi"]))
        )
        .groupBy(feature, "_v")
        .agg(F.count("*").alias("_c"))
    )
    wanted = brackets.select(
        feature, "n", F.posexplode(F.arrays_zip("lo", "hi")).alias("_i", "_e")
    ).join(below, feature)
    probe = F.element_at(F.array(*[F.lit(q) for q in probes]), F.col("_i") + 1)
    h = probe * (F.col("n") - 1)
    wanted = wanted.select(
        feature,
        "_i",
        F.col("_e.lo").alias("_lo"),
        F.col("_e.hi").alias("_hi"),
        (F.floor(h) + 1).alias("_k"),
        F.least(F.floor(h) + 2, F.col("n")).alias("_k1"),
        (h - F.floor(h)).alias("_frac"),
        F.aggregate(
            F.filter("_hist", lambda e: e["_b"] <= F.col("_i")),
            F.lit(0).cast("bigint"),
            lambda a, e: a + e["_c"],
        ).alias("_below"),
    )
    wanted_pinned = pin_small(wanted)
    wanted = wanted if wanted_pinned is None else wanted_pinned
    run = Window.partitionBy(feature, "_i").orderBy("_v")
    ranked = (
        inside.join(wanted, feature)
        .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        .withColumn(
            "_upto",
            F.col("_below")
            + F.sum("_c").over(run.rowsBetween(Window.unboundedPreceding, 0)),
        )
    )
    first_at = lambda k: F.min(F.when(F.col("_upto") >= F.col(k), F.col("_v")))
    edges = ranked.groupBy(feature, "_i").agg(
        first_at("_k").alias("_a"), first_at("_k1").alias("_z"),
        F.first("_frac").alias("_f"),
        (F.first("_below") < F.first("_k")).alias("_ok_lo"),
        (F.max("_upto") >= F.first("_k1")).alias("_ok_hi"),
    )
    # The bracket must really hold both order statistics; the sketch promises it.
    edges = edges.withColumn(
        "_a",
        F.when(F.col("_ok_lo") & F.col("_ok_hi"), F.col("_a")).otherwise(
            F.raise_error(F.lit("quantile bracket too narrow"))
        ),
    )
    return edges.groupBy(feature).agg(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct("_i", (F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_f")).alias("e"))
                )
            ),
            lambda s: s["e"],
        ).alias("edges")
    )


def bin_of(value: Column, edges: Column) -> Column:
    """Bin of a value among open-ended bins closed on the left."""
    return F.size(F.filter(edges, lambda e: value >= e))


def bin_counts(
    df: DataFrame, edges: DataFrame, by: list[str], feature: str = "feature", value: str = "value"
) -> DataFrame:
    """(by, feature, bin, c): rows per bin, with partial counts before the shuffle."""
    return (
        df.where(F.col(value).isNotNull())
        .join(edges, feature)
        .groupBy(*by, feature, bin_of(F.col(value), F.col("edges")).alias("bin"))
        .agg(F.count("*").alias("c"))
    )


def _shares(counts: DataFrame, by: list[str], name: str, bins: int) -> DataFrame:
    """One array of floored bin shares per group; a group has at most ``bins`` rows."""
    hist = counts.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("_m"),
        F.sum("c").alias("_n"),
    )
    return hist.select(
        *by,
        F.transform(
            F.sequence(F.lit(0), F.lit(bins - 1)),
            lambda b: F.greatest(
                F.coalesce(F.element_at("_m", b), F.lit(0)) / F.col("_n"), F.lit(FLOOR)
            ),
        ).alias(name),
    )


def _psi(p: str, q: str | Column) -> Column:
    return F.aggregate(
        F.zip_with(p, q, lambda a, b: (b - a) * F.log(b / a)),
        F.lit(0.0),
        lambda acc, t: acc + t,
    )


def status(psi: Column) -> Column:
    """Status of a PSI, NULL without one; the three names are fixed values."""
    return (
        F.when(psi >= ALERT, "ALERTE").when(psi >= WATCH, "A SURVEILLER").when(psi < WATCH, "stable")
    )


def reference_bins(
    reference: DataFrame, feature: str = "feature", value: str = "value", bins: int = BINS
) -> DataFrame:
    """(feature, edges, shares) of the reference: all that a later comparison needs of it.

    One row a feature, kept as a local table where there are few of them.
    """
    edges = quantile_edges(reference, feature, value, bins)
    pinned = pin_small(edges)
    edges = edges if pinned is None else pinned
    shares = _shares(bin_counts(reference, edges, [], feature, value), [feature], "shares", bins)
    table = edges.join(shares, feature)
    pinned = pin_small(table)
    return table if pinned is None else pinned


def psi_of_counts(shares: str, counts: str) -> Column:
    """PSI of an array of bin counts against the reference's shares, NULL without either."""
    n = F.aggregate(F.col(counts), F.lit(0).cast("bigint"), lambda a, c: a + c)
    floored = F.transform(counts, lambda c: F.greatest(c / n, F.lit(FLOOR)))
    return _psi(shares, floored)


def drift_report(
    reference: DataFrame,
    production: DataFrame,
    by: list[str] = (),
    feature: str = "feature",
    value: str = "value",
    bins: int = BINS,
) -> DataFrame:
    """PSI and status per feature, and per ``by`` group of the production rows.

    Both samples are in long form; all features are handled by the same jobs. A feature
    that only one sample has values of stays in the report, without a PSI: its status says
    which sample lacks it. One that production lacks altogether has NULL as its group.
    """
    by = list(by)
    edges = quantile_edges(reference, feature, value, bins)
    pinned = pin_small(edges)
    edges = edges if pinned is None else pinned
    ref = _shares(bin_counts(reference, edges, [], feature, value), [feature], "_p", bins)
    prod = _shares(
        bin_counts(production, edges, by, feature, value), [*by, feature], "_q", bins
    )
    psi = _psi("_p", "_q")
    both = (
        prod.join(ref, feature, "full")
        .select(*by, feature, psi.alias("psi"))
        .withColumn("status", F.coalesce(status(F.col("psi")), F.lit(NO_PRODUCTION)))
    )
    alone = (
        production.where(F.col(value).isNotNull())
        .select(*by, feature)
        .distinct()
        .join(edges, feature, "left_anti")
        .select(*by, feature, F.lit(None).cast("double").alias("psi"), F.lit(NO_REFERENCE).alias("status"))
    )
    return both.unionByName(alone)


def worst(report: DataFrame, feature: str = "feature") -> DataFrame:
    """The feature that drifts most; ties go to the first name. One without a PSI, since a
    sample lacks it, comes after all others."""
    best = F.min_by(
        F.struct(feature, "psi", "status"),
        F.struct(F.col("psi").isNull().alias("n"), (-F.col("psi")).alias("p"), F.col(feature).alias("f")),
    )
    return report.agg(best.alias("_w")).select("_w.*")
