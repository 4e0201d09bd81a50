"""Quality rules: an isolation forest over rule statistics of whole documents.

The statistics of a document are counts by simple rules. A forest of random splits is
grown on a bounded sample of labelled documents; a document that few splits isolate is
unlike the rest. A statistic is split the more often the better it tells good from bad
labels, so that statistics that vary among good documents do not drown the others. The
score at which a document counts as odd is calibrated on all labelled documents: it is
the one that finds most bad documents while at most ``max_good_lost`` of the good ones
are lost.

Defined results: a null or empty text has no words, so all counts are 0 and the base
rule fails it. Rows are judged one by one, so repeated rows get equal results. Without
labels there is no calibration and only the base rule decides. Columns other than the
named ones are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import row_key, stage_table

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_MARKS = b"!?.,;:"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_distinct", "n_upper", "n_digits", "n_marks", "n_bytes", "n_lines")
STATS_TYPE = ", ".join(f"{c} long" for c in COUNTS + EXTRA)

MIN_WORDS = 50
#: Score bins of the calibration: what reaches the driver is one count for each.
BINS = 2000


@dataclass(frozen=True)
class ForestSize:
    """``trees`` trees of ``rows`` sampled rows each; at most trees * rows labelled
    rows are fetched to grow them. The splits depend on ``seed`` alone."""

    trees: int = 100
    rows: int = 256
    seed: int = 7


def rule_counts(text: str | None) -> tuple[int, ...]:
    """The counts ``COUNTS + EXTRA`` of one text."""
    text = text or ""
    words = _WORD.findall(text)
    raw = text.encode("utf-8", "replace")
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    seen: set[str] = set()
    n_dup = n_lines = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), without(_SYMBOLS), n_dup, repeat_words(words),
        len(set(words)), without(_UPPER), without(_DIGITS), without(_MARKS), len(raw), n_lines,
    )


def repeat_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            hit[i : i + 3] = b"\1\1\1"
            hit[j : j + 3] = b"\1\1\1"
    return sum(hit)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > 50 * n)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as rows of a matrix: shares, so that length hardly matters."""
    c = {k: np.asarray(v, dtype=float) for k, v in counts.items()}
    words, size = np.maximum(c["n_words"], 1), np.maximum(c["n_bytes"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.column_stack([
        c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, np.log1p(words) * (1 - c["n_distinct"] / words),
        c["n_upper"] / size, c["n_digits"] / size, c["n_marks"] / words,
    ])


@dataclass
class Forest:
    """Trees as flat arrays: node i of a tree splits ``feature[i]`` at ``cut[i]``;
    a leaf has feature -1 and its path length in ``cut``."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    normal: float
    threshold: float = field(default=np.inf)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Near 1: isolated by few splits; about 0.5 and below: like the sample."""
        if not self.trees:
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for feature, cut, child in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            live = np.arange(len(x))
            while len(live):
                f = feature[node[live]]
                done = f < 0
                total[live[done]] += cut[node[live[done]]]
                live, f = live[~done], f[~done]
                at = node[live]
                node[live] = child[at] + (x[live, f] >= cut[at])
        return 2.0 ** (-total / (len(self.trees) * self.normal))


def _path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def weights(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How often to split each statistic: (2 AUC - 1) squared between the labels."""
    n_good, n_bad = int(good.sum()), int((~good).sum())
    if not n_good or not n_bad:
        return np.ones(x.shape[1])
    ranks = rankdata(x)[~good].sum(axis=0)
    auc = (ranks - n_bad * (n_bad + 1) / 2) / (n_bad * n_good)
    out = (2 * auc - 1) ** 2
    return out if out.any() else np.ones(x.shape[1])


def rankdata(x: np.ndarray) -> np.ndarray:
    """Ranks from 1 in each column, ties at their mean."""
    out = np.empty(x.shape)
    for j in range(x.shape[1]):
        _, inverse, n = np.unique(x[:, j], return_inverse=True, return_counts=True)
        out[:, j] = (np.cumsum(n) - (n - 1) / 2)[inverse]
    return out


def grow(sample: np.ndarray, good: np.ndarray, size: ForestSize) -> Forest:
    rng = np.random.default_rng(size.seed)
    weight = weights(sample, good) if len(sample) else np.ones(sample.shape[1])
    trees = []
    rows = min(size.rows, len(sample))
    for _ in range(size.trees if rows > 1 else 0):
        part = sample[rng.choice(len(sample), rows, replace=False)]
        trees.append(_tree(part, rng, int(np.ceil(np.log2(rows))), weight))
    return Forest(trees, max(_path(rows), 1e-9))


def _tree(x: np.ndarray, rng, max_depth: int, weight: np.ndarray):
    feature, cut, child = [-1], [0.0], [0]
    work = [(0, x, 0)]
    while work:
        at, rows, depth = work.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero((high > low) & (weight > 0))
        if depth >= max_depth or len(rows) <= 1 or not len(open_):
            cut[at] = depth + _path(len(rows))
            continue
        f = int(rng.choice(open_, p=weight[open_] / weight[open_].sum()))
        c = float(rng.uniform(low[f], high[f]))
        c = c if c > low[f] else float(high[f])
        right = rows[:, f] >= c
        feature[at], cut[at], child[at] = f, c, len(feature)
        for part in (rows[~right], rows[right]):
            work.append((len(feature), part, depth + 1))
            feature.append(-1), cut.append(0.0), child.append(0)
    return np.array(feature), np.array(cut), np.array(child)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key`` and the counts of every row."""

    def run(batches):
        for batch in batches:
            rows = [rule_counts(t) for t in batch.column("text").to_pylist()]
            counts = np.array(rows, dtype=np.int64).reshape(len(rows), len(COUNTS + EXTRA))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key")]
                + [pa.array(counts[:, i]) for i in range(counts.shape[1])],
                names=["doc_id", "row_key", *COUNTS, *EXTRA],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("row_key"),
        F.col(text).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row_key long, {STATS_TYPE}")


def _numbers(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + EXTRA}


def fit(
    stats: DataFrame, labels: DataFrame, size: ForestSize = ForestSize(),
    max_good_lost: float = 0.005,
) -> Forest:
    """Grow the forest on labelled rows of ``stats`` and calibrate its threshold.

    ``labels``: doc_id and quality (1 good, 0 bad; null rows are left out).
    """
    known = labels.select(
        F.col("doc_id"), F.col("quality").cast("int").alias("quality")
    ).where(F.col("quality").isin(0, 1))
    known = stats.join(known, "doc_id")
    # Rows that the base rule fails are decided already; they would only blur the threshold.
    known = known.where(
        (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= 50 * F.col("n_words"))
    )
    sample = (
        known.orderBy(F.xxhash64("doc_id", F.lit(size.seed)), "row_key")
        .limit(size.trees * size.rows)
        .select("quality", *COUNTS, *EXTRA)
        .toPandas()
    )
    good = sample.pop("quality").to_numpy() == 1
    forest = grow(features({c: sample[c].to_numpy() for c in sample}), good, size)
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def bins(batches):
        for batch in batches:
            score = shared.value.scores(features(_numbers(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array((score * BINS).astype(np.int32))],
                names=["quality", "bin"],
            )

    rows = known.mapInArrow(bins, "quality int, bin int").groupBy("quality", "bin").count()
    table = np.zeros((2, BINS + 1))
    for quality, at, n in rows.collect():
        table[quality, min(at, BINS)] += n
    forest.threshold = calibrate(table, max_good_lost)
    return forest


def calibrate(table: np.ndarray, max_good_lost: float) -> float:
    """The score from which on a row is rejected.

    Row 0 of ``table`` counts bad documents by score bin, row 1 good ones. Of the
    thresholds that lose at most the given share of the good ones, the one that gains
    most bad ones less lost good ones; ties go to the higher one.
    """
    bad, good = table[0][::-1].cumsum(), table[1][::-1].cumsum()
    if not bad[-1] or not good[-1]:
        return np.inf
    gain = np.where(good <= max_good_lost * good[-1], bad / bad[-1] - good / good[-1], -1.0)
    best = int(gain.argmax())
    return np.inf if gain[best] <= 0 else (len(gain) - 1 - best) / BINS


def judge(stats: DataFrame, forest: Forest) -> DataFrame:
    """Add ``base_failed``, ``score`` and ``kept`` to rows of counts."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            counts = _numbers(batch)
            failed = base_failed(counts)
            score = shared.value.scores(features(counts))
            kept = ~failed & (score < shared.value.threshold)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(score), pa.array(kept)],
                names=[*batch.schema.names, "base_failed", "score", "kept"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInArrow(run, f"{fields}, base_failed boolean, score double, kept boolean")


def quality_rules(
    docs: DataFrame, labels: DataFrame, size: ForestSize = ForestSize(),
    max_good_lost: float = 0.005,
) -> DataFrame:
    """One row of counts and verdict for each row of ``docs`` (doc_id, text)."""
    stats = stage_table(statistics(docs), "quality")
    return judge(stats, fit(stats, labels, size, max_good_lost))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.

    The texts do not move: each is judged where it is read.
    """
    stats = stage_table(statistics(docs), "quality")
    forest = fit(stats, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            rows = [rule_counts(t) for t in batch.column(at).to_pylist()]
            counts = np.array(rows, dtype=np.int64).reshape(len(rows), len(COUNTS + EXTRA))
            named = dict(zip(COUNTS + EXTRA, counts.T))
            kept = ~base_failed(named)
            kept &= shared.value.scores(features(named)) < shared.value.threshold
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
