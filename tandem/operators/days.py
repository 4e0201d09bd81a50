"""Values kept by day as sketches, pages and counts: exact quantiles and drift of any days.

A day is read once, when it is added. The store then holds three tables, all by day:

* ``sketches`` (feature, n, lo, hi, sketch): a mergeable KLL sketch of each feature;
* ``pages`` (feature, page, n, lo, hi): the feature cut into about 256 pages of equal rows;
* ``values`` (feature, page, v, n): distinct values with their counts, in order.

How many values of a range of days lie below a point is the sum of the pages below it and of
the values in the one page of each day that the point cuts. Quantiles of a range take
candidate points from the merged sketches, and two of them with the exact counts around a
rank bracket it, whatever the error of the sketch; only values inside the bracket are read.

Nulls, NaN and rows without a day or a feature are left out. A day that is added again replaces
what the store had of it; a day of which nothing is given stays. Files of replaced or failed
additions stay in folders of their run, which nothing reads.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.sizing import fits_broadcast, pin_small
from ..plans.skew import lookup
from ..plans.staging import stage_table
from . import drift as dr

# Size of a sketch (rank error about 0.1 %), pages of a day's feature.
SKETCH_K, PAGES = 2048, 256
# Distances, in rank, of the candidate points around a quantile.
AROUND = (0.0015, 0.006, 0.05)
# Distinct values of one bracket that a window may order; beyond it the bracket is narrowed.
WINDOW_VALUES = 1 << 20
# Ranges of values that are handed to the scan as filters; joins decide in any case.
SCAN_RANGES = 256

_TABLES = {
    "sketches": "feature string, n long, lo double, hi double, sketch binary, run string, day string",
    "pages": "feature string, page int, n long, lo double, hi double, day string, run string",
    "values": "feature string, page int, v double, n long, day string, run string",
}
_FOLDERS = {"sketches": ["day"], "pages": ["day", "run"], "values": ["day", "run"]}


def _small(df: DataFrame, name: str) -> DataFrame:
    """A summary evaluated once: a local table if it is small, else a staged one."""
    pinned = pin_small(df)
    return stage_table(df, name) if pinned is None else pinned


def _key() -> Column:
    return F.concat_ws("\n", "day", "feature")


def _with_page(df: DataFrame) -> DataFrame:
    """Add ``page``: how many of the ascending ``cuts``, fewer than ``PAGES``, are at most ``v``.

    A column for each halving: every step reads the one before twice, so none is inlined.
    """
    df = df.withColumn("page", F.lit(0))
    for step in [1 << b for b in reversed(range((PAGES - 1).bit_length()))]:
        beyond = F.coalesce(F.get("cuts", F.col("page") + (step - 1)) <= F.col("v"), F.lit(False))
        df = df.withColumn("page", F.col("page") + F.when(beyond, step).otherwise(0))
    return df


class DayStore:
    """A store of days under ``path``. One writer at a time adds days."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ---- writing ---------------------------------------------------------------------

    def add(self, df: DataFrame, day: str = "day", feature: str = "feature", value: str = "value") -> None:
        """Add the days of a long table (day as ``yyyy-MM-dd``, feature, value).

        Values are counted before they move, so a day of equal values is one row a task.
        """
        v = F.col(value).cast("double")
        rows = df.select(
            F.col(day).cast("string").alias("day"), F.col(feature).cast("string").alias("feature"), v.alias("v")
        ).where("day IS NOT NULL AND feature IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)")
        # Sketches are made of the rows: counts of values would need weights.
        rows = stage_table(rows, "day_rows")
        sketches = stage_table(
            rows.groupBy("day", "feature").agg(
                F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                F.kll_sketch_agg_double("v", F.lit(SKETCH_K)).alias("sketch"),
            ),
            "day_sketches",
        )
        probes = F.array(*[F.lit(i / PAGES) for i in range(1, PAGES)])
        cuts = sketches.select(
            "day", "feature", F.array_distinct(F.kll_sketch_get_quantile_double("sketch", probes)).alias("cuts")
        )
        counts = rows.groupBy("day", "feature", "v").agg(F.count("*").alias("n"))
        # A feature may own most rows of a day.
        counts = stage_table(counts.withColumn("key", _key()), "day_counts")
        cuts = stage_table(cuts.select(_key().alias("key"), "cuts"), "day_cuts")
        joined = lookup(counts, cuts, "key", F.col("v"), counts.groupBy("key").agg(F.count("*").alias("c")), "c")
        values = _with_page(joined).select("feature", "page", "v", "n", "day")
        values = values.repartitionByRange("day", "feature", "v").sortWithinPartitions("day", "feature", "v")
        # Readers follow the run that a day's sketches name, and these come last: a day is read
        # whole, as it was or as it now is, also if this fails on the way.
        run = uuid.uuid4().hex
        self._write("values", values.withColumn("run", F.lit(run)), "append")
        written = self.spark.read.schema(_TABLES["values"]).parquet(f"{self.path}/values").where(F.col("run") == run)
        pages = written.groupBy("day", "feature", "page").agg(
            F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        self._write("pages", pages.coalesce(8).withColumn("run", F.lit(run)), "append")
        self._write("sketches", sketches.withColumn("run", F.lit(run)), "overwrite")

    def _write(self, name: str, table: DataFrame, mode: str) -> None:
        columns = [c.split()[0] for c in _TABLES[name].split(", ")]
        table.select(*columns).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
            *_FOLDERS[name]
        ).parquet(f"{self.path}/{name}")

    # ---- reading ---------------------------------------------------------------------

    def table(self, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """One of the three tables, for the days from ``first`` to ``last``, both included."""
        try:
            df = self.spark.read.schema(_TABLES[name]).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _TABLES[name])
        if first is not None:
            df = df.where(F.col("day") >= first)
        if last is not None:
            df = df.where(F.col("day") <= last)
        if name == "sketches":
            return df
        # One row a day; it prunes the folders of other runs.
        runs = self.table("sketches", first, last).select("day", "run").distinct()
        return df.join(F.broadcast(runs), ["day", "run"]).drop("run")

    def counts_below(
        self, points: DataFrame, first: str | None = None, last: str | None = None, by_day: bool = False
    ) -> DataFrame:
        """(feature, x, below) or (day, feature, x, below): values under each point, exactly.

        ``points`` has (feature, x), each point once.
        """
        keys = ["day", "feature", "x"] if by_day else ["feature", "x"]
        met = self.table("pages", first, last).join(points.select("feature", "x"), "feature")
        whole = met.groupBy(*keys).agg(
            F.sum(F.when(F.col("hi") < F.col("x"), F.col("n")).otherwise(0)).alias("below")
        )
        cut = met.where((F.col("lo") < F.col("x")) & (F.col("hi") >= F.col("x"))).select(
            "day", "feature", "page", "x", "lo", "hi"
        )
        cut = stage_table(cut, "cut_pages")
        ranges = cut.groupBy("feature", "x").agg(F.min("lo").alias("a"), F.max("hi").alias("z"))
        values = self._between(ranges, first, last)
        looked_up = cut.select("day", "feature", "page", "x")
        if fits_broadcast(looked_up):
            looked_up = F.broadcast(looked_up)
        parts = values.join(looked_up, ["day", "feature", "page"]).where(F.col("v") < F.col("x"))
        parts = parts.groupBy(*keys).agg(F.sum("n").alias("below"))
        return whole.unionByName(parts).groupBy(*keys).agg(F.sum("below").alias("below"))

    def _between(self, ranges: DataFrame, first, last) -> DataFrame:
        """Values of the days, by the scan limited to the ranges (feature, a, z) if these are few."""
        values = self.table("values", first, last)
        few = ranges.select("feature", "a", "z").limit(SCAN_RANGES + 1).collect()
        if not few or len(few) > SCAN_RANGES:
            return values
        merged: list[list] = []
        for feature, a, z in sorted(map(tuple, few)):
            if merged and merged[-1][0] == feature and a <= merged[-1][2]:
                merged[-1][2] = max(z, merged[-1][2])
            else:
                merged.append([feature, a, z])
        within = [(F.col("feature") == f) & (F.col("v") >= a) & (F.col("v") <= z) for f, a, z in merged]
        return values.where(reduce(Column.__or__, within))

    def edges(self, first: str | None = None, last: str | None = None, bins: int = dr.BINS) -> DataFrame:
        """(feature, n, edges): interior quantile edges of the days, exact and interpolated
        like those of ``drift.quantile_edges``."""
        probes = [i / bins for i in range(1, bins)]
        merged = self.table("sketches", first, last).groupBy("feature").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
        ranks = sorted({min(max(q + s * d, 0.0), 1.0) for q in probes for d in AROUND for s in (-1, 1)})
        tried = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(r) for r in ranks]))
        merged = _small(
            merged.select(
                "feature", "n",
                F.array_distinct(F.concat(tried, F.array("lo", "hi"))).alias("points"),
            ),
            "merged_sketches",
        )
        h = F.element_at(F.array(*[F.lit(q) for q in probes]), F.col("i") + 1) * (F.col("n") - 1)
        wanted = merged.select("feature", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 2))).alias("i")).select(
            "feature", "n", "i", (F.floor(h) + 1).alias("k"), F.least(F.floor(h) + 2, F.col("n")).alias("k1"),
            (h - F.floor(h)).alias("frac"),
        )
        wanted = _small(wanted, "wanted_ranks")
        brackets = self._brackets(wanted, merged.select("feature", F.explode("points").alias("x")), first, last)
        while True:
            inside = self._inside(brackets, first, last)
            crowded = inside.groupBy("feature", "i").agg(F.count("*").alias("values")).where(
                F.col("values") > WINDOW_VALUES
            )
            crowded = _small(crowded, "crowded_brackets")
            if crowded.isEmpty():
                break
            # New points halve the crowded brackets many times over, by their own values.
            shares = [s / 64 for s in range(1, 64)]
            points = inside.join(crowded, ["feature", "i"]).groupBy("feature", "i").agg(
                F.percentile_approx("v", shares, 1000).alias("points")
            )
            old = brackets.select("feature", F.explode(F.array("lo", "hi")).alias("x"))
            new = points.select("feature", F.explode("points").alias("x"))
            brackets = self._brackets(wanted, old.unionByName(new).distinct(), first, last)
        run = Window.partitionBy("feature", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        upto = inside.join(wanted, ["feature", "i"]).withColumn("upto", F.col("below") + F.sum("c").over(run))
        at = lambda k: F.min(F.when(F.col("upto") >= F.col(k), F.col("v")))
        found = upto.groupBy("feature", "n", "i").agg(
            at("k").alias("a"), at("k1").alias("z"), F.first("frac").alias("frac")
        )
        edge = F.col("a") + F.when((F.col("z") == F.col("a")) | (F.col("frac") == 0), 0.0).otherwise((F.col("z") - F.col("a")) * F.col("frac"))
        ordered = F.array_sort(F.collect_list(F.struct("i", edge.alias("e"))))
        return found.groupBy("feature", "n").agg(F.transform(ordered, lambda s: s["e"]).alias("edges"))

    def _brackets(self, wanted: DataFrame, points: DataFrame, first, last) -> DataFrame:
        """(feature, i, lo, hi, below): the closest points around each wanted rank, by exact counts."""
        points = _small(points, "points")
        counted = _small(self.counts_below(points, first, last), "counted_points")
        lower, upper = F.col("below") < F.col("k"), F.col("below") >= F.col("k1")
        met = wanted.join(counted, "feature").groupBy("feature", "i").agg(
            F.max(F.when(lower, F.struct("x", "below"))).alias("_low"),
            F.min(F.when(upper, F.col("x"))).alias("_up"), F.max("x").alias("_top"),
        )
        return _small(
            met.select(
                "feature", "i", F.col("_low.x").alias("lo"), F.coalesce("_up", "_top").alias("hi"),
                F.col("_low.below").alias("below"),
            ),
            "brackets",
        )

    def _inside(self, brackets: DataFrame, first, last) -> DataFrame:
        """(feature, i, below, v, c): distinct values inside each bracket with their counts."""
        values = self._between(brackets.select("feature", F.col("lo").alias("a"), F.col("hi").alias("z")), first, last)
        met = values.join(brackets, "feature").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        return stage_table(
            met.groupBy("feature", "i", "below", "v").agg(F.sum("n").alias("c")), "inside_brackets"
        )

    def bin_counts(
        self, edges: DataFrame, first: str | None = None, last: str | None = None, by_day: bool = False
    ) -> DataFrame:
        """(feature, n, counts) or with day: rows of each bin between the edges, as an array.

        A day without values of a feature has no row. Features without edges are left out.
        """
        keys = ["day", "feature"] if by_day else ["feature"]
        points = edges.select("feature", F.explode("edges").alias("x")).distinct()
        below = self.counts_below(_small(points, "edge_points"), first, last, by_day).groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("x", "below"))).alias("_below")
        )
        total = self.table("sketches", first, last).groupBy(*keys).agg(F.sum("n").alias("n"))
        upto = F.concat(F.transform("edges", lambda e: F.element_at("_below", e)), F.array("n"))
        before = F.concat(F.array(F.lit(0).cast("long")), F.transform("edges", lambda e: F.element_at("_below", e)))
        return (
            total.join(edges.select("feature", "edges"), "feature").join(below, keys)
            .select(*keys, "n", F.zip_with(upto, before, lambda u, b: u - b).alias("counts"))
        )

    def report(
        self, reference: tuple[str | None, str | None], production: tuple[str | None, str | None],
        by_day: bool = False, bins: int = dr.BINS,
    ) -> DataFrame:
        """PSI and status per feature, or per day of production and feature, between two
        ranges of days, from the store alone.

        As in ``drift.drift_report``, a feature that one range lacks stays, without a PSI; one
        that production lacks has NULL as its day.
        """
        edges = _small(self.edges(*reference, bins), "reference_edges")
        shares = self.bin_counts(edges, *reference).select(
            "feature", F.transform("counts", lambda c: F.greatest(c / F.col("n"), F.lit(dr.FLOOR))).alias("_p")
        )
        shares = _small(shares, "reference_shares")
        keys = ["day", "feature"] if by_day else ["feature"]
        counts = self.bin_counts(edges, *production, by_day)
        seen = self.table("sketches", *production).select(*keys).distinct()
        both = seen.join(counts, keys, "left").join(shares, "feature", "full")
        status = F.when(F.col("_p").isNull(), dr.NO_REFERENCE).when(F.col("counts").isNull(), dr.NO_PRODUCTION)
        out = both.withColumn("psi", F.when(status.isNull(), dr.psi_of_counts("_p", "counts")))
        return out.select(*keys, "psi", F.coalesce(status, dr.status(F.col("psi"))).alias("status"))
