"""Spark ML estimators on the library's features: text, pair and fairness models."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.binding import computed
from ..plans.staging import stage_table
from . import metrics as mt
from . import network, newton, rowspace

# Rows that ``training_sample`` leaves. The models here are fitted on all labelled rows.
TRAIN_ROWS = 200_000
_NO_CUT = 2**31 - 1
# Steps of the first fit from which Newton's method goes on.
WARM_STEPS = 30


def balanced_weight(df: DataFrame, label: str, weight: str | None = None) -> Column:
    """Weight that gives both classes of a boolean label the same total."""
    w = F.col(weight) if weight else F.lit(1.0)
    n, pos = df.agg(
        F.sum(w).cast("double"), F.sum(F.when(F.col(label), w).otherwise(0.0)).cast("double")
    ).first()
    if not pos or pos == n:
        raise ValueError("both classes must be present")
    return w * F.when(F.col(label), F.lit(n / (2 * pos))).otherwise(F.lit(n / (2 * (n - pos))))


def fit_logistic(
    df: DataFrame,
    features: str,
    label: str,
    balanced: bool = True,
    weight: str | None = None,
    max_iter: int = 1000,
    tol: float = 1e-6,
):
    """L2-regularised logistic regression with unit penalty on the summed loss.

    ``weight`` counts how many equal rows a row stands for, so a table of distinct
    feature vectors trains the same model as the rows it summarises.
    """
    base = F.col(weight).cast("double") if weight else F.lit(1.0)
    w = balanced_weight(df, label, weight) if balanced else base
    data = df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"), w.alias("_w"))
    total = data.agg(F.sum("_w")).first()[0]
    model = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="_w",
        regParam=1.0 / total, elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tol,
    ).fit(data)
    if model.summary.totalIterations >= max_iter:
        warnings.warn(f"logistic regression stopped after {max_iter} iterations")
    return model


def fit_optimum(
    df: DataFrame, features: str, label: str, balanced: bool = True, max_iter: int = 1000,
    tol: float = 1e-6,
):
    """The same regression on sparse vectors of many terms, to a gradient below ``tol``.

    Spark's own fit of a few steps is the start of Newton's method.
    """
    w = balanced_weight(df, label) if balanced else F.lit(1.0)
    data = df.select(
        F.col(features).alias("features"), F.col(label).cast("double").alias("label"),
        w.cast("double").alias("weight"),
    )
    data = stage_table(data, "labelled_vectors")
    n = data.agg(F.sum("weight")).first()[0]
    first = LogisticRegression(
        weightCol="weight", regParam=1.0 / n, elasticNetParam=0.0, standardization=False,
        maxIter=WARM_STEPS,
    ).fit(data)
    start = np.append(first.coefficients.toArray(), first.intercept)
    blocks = newton.pack(data, len(start) - 1)
    found = newton.fit(blocks, len(start) - 1, 1.0, tol, max_iter, start)
    if found.gradient > tol:
        warnings.warn(f"the gradient is {found.gradient:.1e} after {found.steps} steps")
    return found.model(df.sparkSession)


def training_sample(df: DataFrame, text: str, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """All rows if there are at most ``max_rows``, else about that many, chosen by a hash
    of the text; equal texts are kept or left together. For callers that want a part: no
    model here and no query does."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(text), F.lit(n)) < max_rows)


def assemble(df: DataFrame, columns, output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def positive(model_output: str = "probability") -> Column:
    return vector_to_array(F.col(model_output))[1]


def _numbered(df: DataFrame, name: str, number: str) -> DataFrame:
    """``df`` staged with its rows numbered from 0."""
    staged = stage_table(df.withColumn("_id", F.monotonically_increasing_id()), name)
    # An id has the number of its task above, and its place in the task in the lower 33 bits.
    task = F.shiftright("_id", 33)
    firsts, at = [], 0
    for part, n in sorted(staged.groupBy(task.alias("_task")).count().collect()):
        firsts.append((part, at - (part << 33)))
        at += n
    shift = df.sparkSession.createDataFrame(firsts, "_task long, _shift long")
    return (
        staged.withColumn("_task", task).join(F.broadcast(shift), "_task")
        .withColumn(number, F.col("_id") + F.col("_shift")).drop("_id", "_task", "_shift")
    )


def _term_counts(rows: DataFrame, row_id: str, terms: Column) -> DataFrame:
    """(row, term, tf) of a column of terms."""
    return (
        rows.select(F.col(row_id).alias("row"), F.explode(terms).alias("term"))
        .groupBy("row", "term").agg(F.count("*").cast("double").alias("tf"))
    )


def _known(counts: DataFrame, min_df: float, n: int) -> DataFrame:
    """(term, df) of the terms that at least ``min_df`` rows have, or that share of ``n`` rows."""
    least = min_df if min_df >= 1 else min_df * n
    return counts.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= least)


def _fit_terms(rows: DataFrame, values: DataFrame, max_iter: int, tol: float, rank: int):
    """Fit of ``rows`` (row, label, weight) on ``values`` (row, term, value), and the
    coefficients of the terms."""
    blocks = rowspace.pack(values)
    known = rows.select("row", F.col("label").cast("double"), F.col("weight").cast("double")).toArrow()
    order = np.argsort(known.column("row").to_numpy())
    label, weight = (known.column(c).to_numpy()[order].astype(float) for c in ("label", "weight"))
    found = rowspace.fit(blocks, label, weight, tol, max_iter, rank)
    if found.gradient > tol:
        warnings.warn(f"the gradient is {found.gradient:.1e} after {found.steps} steps")
    return found, rowspace.coefficients(blocks, found.rows)


def _probabilities(
    df: DataFrame, terms: Column, table: DataFrame, intercept: float, unit: bool, output: str
) -> DataFrame:
    """``df`` with the probability of each row; ``table`` has (term, scale, coefficient), and
    vectors of ``unit`` length are divided by theirs. A row's terms are added in their order,
    so equal terms have equal sums."""
    rows = stage_table(df.withColumn("_id", F.monotonically_increasing_id()), "to_score")
    entry = F.struct("term", (F.col("tf") * F.col("scale")).alias("x"), "coefficient")
    lists = _term_counts(rows, "_id", terms).join(table, "term").groupBy("row").agg(
        F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    add = lambda f: F.aggregate("_entries", F.lit(0.0), lambda total, e: total + f(e))
    z = add(lambda e: e["x"] * e["coefficient"])
    if unit:
        z = z / F.sqrt(add(lambda e: e["x"] * e["x"]))
    sums = lists.select(F.col("row").alias("_id"), z.alias("_z"))
    p = 1 / (1 + F.exp(-(F.coalesce("_z", F.lit(0.0)) + F.lit(intercept))))
    return rows.join(sums, "_id", "left").withColumn(output, p).drop("_id", "_z")


class TextClassifier:
    """TF-IDF over words and word pairs with a logistic regression."""

    def __init__(self, min_df: float = 1.0, threshold: float = 0.5, max_iter: int = 1000) -> None:
        self.min_df = min_df
        self.max_iter = max_iter
        self.threshold = threshold
        # (term, scale, coefficient), as many rows as the vocabulary has terms.
        self.terms: DataFrame | None = None
        self.model = None

    @staticmethod
    def _terms(text: str) -> Column:
        return tx.ngrams_1_2(tx.tokens(F.col(text)))

    def _values(self, rows: DataFrame, row_id: str, text: str) -> tuple[DataFrame, DataFrame]:
        """(row, term, value) of rows to be trained on, and (term, scale)."""
        n = rows.count()
        counts = stage_table(_term_counts(rows, row_id, self._terms(text)), "term_counts")
        scales = _known(counts, self.min_df, n).select(
            "term", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("scale")
        )
        scales = stage_table(scales, "term_scales")
        x = counts.join(scales, "term").select("row", "term", (F.col("tf") * F.col("scale")).alias("x"))
        norms = x.groupBy("row").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
        values = x.join(norms, "row").select("row", "term", (F.col("x") / F.col("norm")).alias("value"))
        return stage_table(values, "term_values"), scales

    def fit(self, df: DataFrame, text: str, label: str) -> "TextClassifier":
        df = df.select(text, F.col(label).alias("label"))
        rows = _numbered(df.withColumn("weight", F.lit(1.0)), "text_rows", "row")
        values, scales = self._values(rows, "row", text)
        # Rows of unit length: few directions stand out.
        self.model, weights = _fit_terms(rows, values, self.max_iter, 1e-6, 32)
        self.terms = stage_table(scales.join(weights, "term"), "text_model")
        return self

    def vectors(self, df: DataFrame, row_id: str, text: str) -> tuple[DataFrame, int]:
        """Rows of ``df`` with their sparse vectors as ``features``, and the size of these."""
        if self.terms is None:
            raise RuntimeError("model not trained: call fit first")
        numbered = _numbered(self.terms.select("term", "scale"), "term_numbers", "at")
        size = self.terms.count()
        rows = stage_table(df.withColumn("_id", F.monotonically_increasing_id()), "to_pack")
        entry = F.struct(F.col("at").cast("int").alias("at"), (F.col("tf") * F.col("scale")).alias("x"))
        lists = _term_counts(rows, "_id", self._terms(text)).join(numbered, "term").groupBy("row").agg(
            F.array_sort(F.collect_list(entry)).alias("_entries")
        )
        none = F.array().cast("array<struct<at:int,x:double>>")
        norm = F.sqrt(F.aggregate("_entries", F.lit(0.0), lambda total, e: total + e["x"] * e["x"]))
        features = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
            F.transform("_entries", lambda e: e["at"]).alias("indices"),
            F.transform("_entries", lambda e: e["x"] / F.col("_norm")).alias("values"),
        )
        out = rows.join(lists.withColumnRenamed("row", "_id"), "_id", "left")
        # The norm is bound once: written into each entry's expression it would be added up anew for it.
        out = computed(out.withColumn("_entries", F.coalesce("_entries", none)), {"_norm": norm})
        return out.withColumn("features", features).drop("_id", "_entries", "_norm"), size

    def stationarity(self, df: DataFrame, row_id: str, text: str, label: str) -> DataFrame:
        """``stationarity`` of the fit on the rows it was fitted on."""
        values, _ = self._values(df, row_id, text)
        rows = df.select(
            F.col(row_id).alias("row"), F.col(label).cast("double").alias("label"),
            F.lit(1.0).alias("weight"),
        )
        return stationarity(rows, values, self.terms.select("term", "coefficient"), self.model.intercept)

    def fit_lists(self, spark, lines: list[str], labels: list[bool]) -> "TextClassifier":
        if len(lines) != len(labels):
            raise ValueError("every line needs exactly one label")
        rows = list(zip(range(len(lines)), lines, labels))
        return self.fit(spark.createDataFrame(rows, "row_id long, line string, label boolean"), "line", "label")

    def probability(self, df: DataFrame, text: str, output: str) -> DataFrame:
        """``df`` with the probability ``output``."""
        if self.model is None:
            raise RuntimeError("model not trained: call fit first")
        return _probabilities(df, self._terms(text), self.terms, self.model.intercept, True, output)

    def transform(self, df: DataFrame, text: str) -> DataFrame:
        """Add ``is_skill`` and ``confidence``."""
        return (
            self.probability(df, text, "_p")
            .withColumn("is_skill", F.col("_p") >= self.threshold)
            .withColumn("confidence", F.round("_p", 3))
            .drop("_p")
        )


class WordModel:
    """Bag of words with a balanced logistic regression.

    ``prepare`` is a Column-to-Column function applied to the lower-cased text both in
    training and in use; the neutralised model passes ``metrics.neutralize``.
    """

    def __init__(self, prepare=None, min_df: float = 1.0, max_iter: int = 1000) -> None:
        self.prepare = prepare
        self.min_df = min_df
        self.max_iter = max_iter
        # (term, scale, coefficient), as many rows as the vocabulary has terms.
        self.terms: DataFrame | None = None
        self.model = None

    def _terms(self, text: str) -> Column:
        t = F.lower(F.col(text))
        return tx.tokens(self.prepare(t) if self.prepare else t)

    def _values(self, rows: DataFrame, row_id: str, text: str) -> DataFrame:
        """(row, term, value) of rows to be trained on."""
        counts = stage_table(_term_counts(rows, row_id, self._terms(text)), "term_counts")
        if self.min_df not in (0, 1):
            counts = counts.join(_known(counts, self.min_df, rows.count()).select("term"), "term")
        return counts.select("row", "term", F.col("tf").alias("value"))

    def fit(self, df: DataFrame, text: str, label: str) -> "WordModel":
        df = df.select(text, F.col(label).alias("label"))
        rows = _numbered(df.withColumn("weight", balanced_weight(df, "label")), "word_rows", "row")
        values = self._values(rows, "row", text)
        self.model, weights = _fit_terms(rows, values, self.max_iter, 1e-6, rowspace.RANK)
        self.terms = stage_table(weights.withColumn("scale", F.lit(1.0)), "word_model")
        return self

    def transform(self, df: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """Add the probability ``score`` and the strict decision ``selected``."""
        if self.model is None:
            raise RuntimeError("model not trained: call fit first")
        scored = _probabilities(df, self._terms(text), self.terms, self.model.intercept, False, score)
        return scored.withColumn("selected", F.col(score) > 0.5)

    def coefficients(self) -> DataFrame:
        """(word, coefficient) of the vocabulary."""
        return self.terms.select(F.col("term").alias("word"), "coefficient")

    def stationarity(self, df: DataFrame, row_id: str, text: str, label: str) -> DataFrame:
        """``stationarity`` of the fit on the rows it was fitted on."""
        rows = df.select(
            F.col(row_id).alias("row"), F.col(label).cast("double").alias("label"),
            balanced_weight(df, label).alias("weight"),
        )
        values = self._values(df, row_id, text)
        return stationarity(rows, values, self.terms.select("term", "coefficient"), self.model.intercept)


def stationarity(
    rows: DataFrame, values: DataFrame, coefficients: DataFrame, intercept: float,
    penalty: float = 1.0,
) -> DataFrame:
    """What is left of the gradient of a penalised logistic regression, term by term, from
    nothing but the coefficients: (term, n_rows, residual), zero at the optimum.

    ``rows`` has (row, label, weight), ``values`` (row, term, value), ``coefficients`` (term,
    coefficient). The intercept's part has the term ``(intercept)``.
    """
    values = stage_table(values, "term_values")
    z = values.join(coefficients, "term").groupBy("row").agg(
        F.sum(F.col("value") * F.col("coefficient")).alias("z")
    )
    p = 1 / (1 + F.exp(-(F.coalesce("z", F.lit(0.0)) + intercept)))
    slopes = rows.join(z, "row", "left").select(
        "row", (F.col("weight") * (p - F.col("label"))).alias("slope")
    )
    slopes = stage_table(slopes, "slopes")
    terms = values.join(slopes, "row").groupBy("term").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("value") * F.col("slope")).alias("pull")
    )
    left = terms.join(coefficients, "term", "full").select(
        "term", "n_rows", (F.col("pull") + penalty * F.col("coefficient")).alias("residual")
    )
    whole = slopes.agg(F.count("*").alias("n_rows"), F.sum("slope").alias("residual"))
    return left.unionByName(whole.select(F.lit("(intercept)").alias("term"), "n_rows", "residual"))


def worst_words(coefficients: DataFrame, k: int = 3) -> DataFrame:
    return coefficients.orderBy("coefficient", "word").limit(k)


def ghost_gap(
    model: WordModel, twins: DataFrame, base: str = "base_text", marked: str = "marked_text"
) -> DataFrame:
    """Score of the neutral text minus the score of its marked twin, per row."""
    first = model.transform(twins, base, "p_neutral").drop("selected")
    both = model.transform(first, marked, "p_marked").drop("selected")
    return both.withColumn("gap", F.col("p_neutral") - F.col("p_marked"))


def audit(
    model: WordModel, df: DataFrame, name: str, group: str, truth: str, favoured: str, other: str
) -> DataFrame:
    """(model, metric, value): selection rates, impact ratio and utility of a model."""
    scored = model.transform(df)
    impact = mt.disparate_impact(scored, group, "selected", favoured, other).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                    for m in ("rate_a", "rate_b", "impact")
                ]
            )
        )
    )
    f1 = mt.binary_metrics(scored, truth, "selected").select(
        F.lit("utility_f1").alias("metric"), F.col("f1").alias("value")
    )
    return impact.unionByName(f1).select(F.lit(name).alias("model"), "metric", "value")


def compare_models(
    df: DataFrame, row_id: str, text: str, label: str, min_df: float = 1.0, seed: int = 42,
    max_iter: int = 1000, epochs: int = 60,
) -> DataFrame:
    """Probabilities of the linear model and the network, side by side per row, both on the
    same sparse vectors."""
    linear = TextClassifier(min_df=min_df, max_iter=max_iter).fit(df, text, label)
    packed, width = linear.vectors(linear.probability(df, text, "p_linear"), row_id, text)
    vec = stage_table(packed.select(row_id, label, "p_linear", "features"), "vectors")
    deep = network.fit(vec, "features", label, width, seed, epochs)
    return deep.predict(vec, "features", "p_network")
