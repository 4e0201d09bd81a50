"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its byte trigrams, hashed to ``DIMS`` places,
letters and digits only, words set apart by one space. Document frequencies are counted over
all training texts. For each language a bounded sample of training texts is clustered into
a few centroids; a text gets the language of the centroid with the largest cosine. It is
rejected if that cosine is below what the centroid's own texts have.

Defined results: a null text, and one without a letter, is ``und`` with score 0. So is every
text if there is nothing to learn from. Of equal cosines the language first by name wins.
Rows are judged one by one, so repeated rows get equal results. Language, source and id of a
row are no input of its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw

DIMS = 4096
#: Training texts of each language that its centroids are made of.
SAMPLE_PER_LANG = 400
CENTROIDS = 4
ROUNDS = 10
#: A text is rejected below this share of the least cosine of a centroid's own texts.
REJECT_SHARE = 0.5
UNKNOWN = "und"

_ROWS = 256
_LETTER = regex.compile(r"\p{L}")


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed trigrams, one row of ``DIMS`` for each text."""
    words = bw.split_words(texts, bw.ALPHANUMERIC)
    n = len(texts)
    data = words.data.astype(np.uint64)
    if len(data) < 3:
        return np.zeros((n, DIMS), dtype=np.float32)
    code = data[:-2] | (data[1:-1] << np.uint64(8)) | (data[2:] << np.uint64(16))
    at = (bw.mix(code) & np.uint64(DIMS - 1)).astype(np.int64)
    # Byte ranges of the texts; a trigram must stay inside.
    first = np.concatenate([words.starts, [len(words.data)]])[words.bounds]
    doc = np.repeat(np.arange(n), np.diff(first))[: len(at)]
    inside = np.arange(len(at)) + 2 < first[1:][doc]
    counts = np.bincount(doc[inside] * DIMS + at[inside], minlength=n * DIMS)
    return counts.reshape(n, DIMS).astype(np.float32)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts; a row without counts stays zero."""
    x = np.sqrt(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm == 0, 1, norm)).astype(np.float32)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of few rows, since each row takes a whole vector."""
    for batch in bw.slices(batches, "text"):
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``texts`` (text) each place occurs, and how many there are."""

    def run(batches):
        df, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in _small(batches):
            df += (trigram_counts(batch.column("text")) > 0).sum(axis=0)
            n += batch.num_rows
        places = np.append(np.arange(DIMS), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array(np.append(df, n))], names=["place", "df"]
        )

    rows = texts.select("text").mapInArrow(run, "place int, df long")
    counted = rows.groupBy("place").agg(F.sum("df").alias("df")).collect()
    out, n = np.zeros(DIMS, dtype=np.int64), 0
    for place, df in counted:
        if place < 0:
            n = df
        else:
            out[place] = df
    return out, n


def cluster(x: np.ndarray, k: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by k-means on the sphere, and each one's least cosine.

    The first centroid is the mean; each further one starts at the text farthest from those
    there are. One that loses all its texts is dropped.
    """
    x = x[np.abs(x).sum(axis=1) > 0]
    if not len(x):
        return np.zeros((0, DIMS), dtype=np.float32), np.zeros(0)
    unit = lambda v: v / max(float(np.linalg.norm(v)), 1e-12)
    centers = [unit(x.mean(axis=0))]
    while len(centers) < min(k, len(x)):
        near = (x @ np.array(centers).T).max(axis=1)
        centers.append(x[int(near.argmin())])
    c = np.array(centers)
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([unit(x[own == i].mean(axis=0)) for i in range(len(c)) if (own == i).any()])
    cosines = x @ c.T
    own = cosines.argmax(axis=1)
    least = [cosines[own == i, i].min() if (own == i).any() else 0.0 for i in range(len(c))]
    return c.astype(np.float32), np.array(least)


@dataclass
class Centroids:
    langs: list[str]
    idf: np.ndarray
    matrix: np.ndarray
    least: np.ndarray

    def nearest(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is too far from all of them, for each text."""
        has = np.array([bool(t) and bool(_LETTER.search(t)) for t in texts.to_pylist()], bool)
        if not len(self.langs):
            return [UNKNOWN] * len(has), np.zeros(len(has)), np.ones(len(has), dtype=bool)
        cosine = vectors(trigram_counts(texts), self.idf) @ self.matrix.T
        at = cosine.argmax(axis=1)
        best = np.clip(cosine[np.arange(len(at)), at].astype(float), 0, 1)
        far = best < REJECT_SHARE * self.least[at]
        langs = [self.langs[i] if ok else UNKNOWN for i, ok in zip(at.tolist(), has)]
        return langs, np.where(has, best, 0.0), far | ~has


def fit(
    labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG, k: int = CENTROIDS
) -> Centroids:
    """Learn from ``labelled`` (key, text, lang); rows without text or lang are left out.

    Frequencies come from all rows. At most ``sample_per_lang`` texts of each language, those
    with the least hash of ``key`` and text, are clustered, each language in a task of its own; the
    centroids, a few vectors for each language, are fetched.
    """
    rows = labelled.where("text is not null and lang is not null")
    df, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    rank = F.pmod(F.xxhash64(F.col("key"), F.col("text"), F.lit("sample")), F.lit(1 << 30))
    ranked = rows.select("lang", "text", rank.alias("rank"))
    # Repeated rows share a rank and stand in the sample once, so ranks are counted, not rows.
    counts = ranked.groupBy("lang").agg(F.count_distinct("rank").alias("n"))
    # About twice the sample by hash first, so that no language is gathered whole.
    sample = (
        ranked.join(F.broadcast(counts), "lang")
        .where(F.col("rank") * F.col("n") < 2.0 * sample_per_lang * (1 << 30))
        .groupBy("lang", "rank").agg(F.min("text").alias("text"))
    )

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        chosen = group.sort_values(["rank", "text"])["text"].head(sample_per_lang)
        batch = pa.RecordBatch.from_arrays([pa.array(chosen, pa.string())], names=["text"])
        x = [vectors(trigram_counts(b.column("text")), idf) for b in _small(iter([batch]))]
        c, least = cluster(np.concatenate(x), k)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "least": least, "vector": list(c)})

    made = (
        sample.groupBy("lang")
        .applyInPandas(centroids, "lang string, least double, vector array<float>")
        .toPandas()
    )
    made["order"] = made.groupby("lang").cumcount()
    made = made.sort_values(["lang", "order"])
    matrix = np.array(made["vector"].tolist(), dtype=np.float32).reshape(len(made), DIMS)
    return Centroids(made["lang"].tolist(), idf, matrix, made["least"].to_numpy(float))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """``docs`` (columns given, with ``text``) with ``lang_pred``, ``score``, ``rejected`` in
    place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in _small(batches):
            langs, score, far = shared.value.nearest(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(langs, pa.string()), pa.array(score), pa.array(far)],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column, mod: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == rest


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, and judge all rows of ``docs``."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", "lang")
    model = fit(rows.where("not held_out").select(F.col("doc_id").alias("key"), "text", "lang"))
    return predict(rows.select("doc_id", "held_out", "text"), model)
