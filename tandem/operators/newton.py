"""Logistic regression to its optimum: trust-region Newton over sparse rows.

Rows are packed once as sparse blocks and written. Every step is a pass of Spark over them:
tasks multiply their blocks with the vector at hand and add up what comes out, so only sums
as long as the vocabulary leave a task. Few of them are added by the driver; many are first
added by parts of the vocabulary in a shuffle. Directions come from conjugate gradients,
preconditioned by the diagonal of the Hessian, which is never formed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import scratch_path, stage_table

# Entries of a packed block, and numbers added in one group of the shuffle.
BLOCK_ENTRIES, PART = 1 << 20, 65_536
# Bytes of sums that the driver adds by itself.
DRIVER_BYTES = 64 << 20

_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
_BLOCK = "rows binary, at binary, value binary, label binary, weight binary"


@dataclass
class Fit:
    """``weights`` end with the intercept; ``gradient`` is the largest part of it left."""

    weights: np.ndarray
    gradient: float
    steps: int
    passes: int

    def model(self, spark: SparkSession) -> LogisticRegressionModel:
        """The fit as a model of Spark ML."""
        vector = _py2java(spark.sparkContext, Vectors.dense(self.weights[:-1]))
        kind = spark.sparkContext._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
        java = kind("tandem_newton", vector, float(self.weights[-1]))
        return LogisticRegressionModel(java)


def pack(df: DataFrame, size: int) -> DataFrame:
    """Sparse blocks of (features, label, weight); an entry of one at ``size`` ends a row."""
    path = scratch_path(df.sparkSession, "newton_rows")
    df.select("features", "label", "weight").write.parquet(path)
    plain = f"features {_VECTOR}, label double, weight double"
    rows = df.sparkSession.read.schema(plain).parquet(path)
    entries = rows.agg(F.sum(F.size("features.values") + 1)).first()[0] or 0
    rows = rows.coalesce(max(1, -(-entries // BLOCK_ENTRIES)))

    def run(batches):
        held, entries = [], 0

        def block():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([np.concatenate(c).astype(t).tobytes()], pa.binary())
                    for c, t in zip(zip(*held), ("<i4", "<i4", "<f8", "<f8", "<f8"))
                ],
                names=["rows", "at", "value", "label", "weight"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                x = row["features"]
                value = np.array(x["values"], dtype=float)
                at = np.arange(len(value)) if x["type"] == 1 else np.array(x["indices"], dtype=int)
                held.append(
                    ([len(at) + 1], np.append(at, size), np.append(value, 1.0), [row["label"]], [row["weight"]])
                )
                entries += len(at) + 1
                if entries >= BLOCK_ENTRIES:
                    yield block()
                    held, entries = [], 0
        if held:
            yield block()

    return stage_table(rows.mapInArrow(run, _BLOCK), "newton_blocks")


class Problem:
    """Weighted log loss of packed rows plus half the squared weights times ``penalty``."""

    def __init__(self, blocks: DataFrame, size: int, penalty: float) -> None:
        self.blocks, self.size, self.penalty = blocks, size, penalty
        self.passes = 0
        self.n_blocks = blocks.count()
        self.penalties = np.append(np.full(size, penalty), 0.0)

    def _sums(self, terms, n_vectors: int) -> np.ndarray:
        """Sums over all rows of ``terms(block)``, vectors as long as the weights plus one
        for the loss."""
        length = n_vectors * (self.size + 1) + 1

        def run(batches):
            total = np.zeros(length)
            for batch in batches:
                for row in batch.to_pylist():
                    total += terms(
                        *(np.frombuffer(row[c], t) for c, t in
                          (("rows", "<i4"), ("at", "<i4"), ("value", "<f8"), ("label", "<f8"), ("weight", "<f8")))
                    )
            for start in range(0, length, PART):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start], pa.int64()), pa.array([total[start : start + PART].tobytes()], pa.binary())],
                    names=["start", "sums"],
                )

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, "<f8") for x in group.column("sums").to_pylist())
            return pa.table({"start": group.column("start").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

        rows = self.blocks.mapInArrow(run, "start long, sums binary")
        if self.n_blocks * length * 8 > DRIVER_BYTES:
            rows = rows.groupBy("start").applyInArrow(add, "start long, sums binary")
        out = np.zeros(length)
        got = rows.toArrow()
        for start, sums in zip(got.column("start").to_pylist(), got.column("sums").to_pylist()):
            out[start : start + PART] += np.frombuffer(sums, "<f8")
        self.passes += 1
        return out

    def at(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and the Hessian's diagonal."""
        n = self.size + 1

        def terms(rows, at, value, label, weight):
            z, _ = _products(rows, at, value, w)
            p = _sigmoid(z)
            slope, curve = weight * (p - label), weight * p * (1 - p)
            loss = (weight * (np.logaddexp(0, z) - label * z)).sum()
            g = np.bincount(at, value * np.repeat(slope, rows), n)
            h = np.bincount(at, value * value * np.repeat(curve, rows), n)
            return np.concatenate([g, h, [loss]])

        out = self._sums(terms, 2)
        loss = out[-1] + 0.5 * float(self.penalties @ (w * w))
        return loss, out[:n] + self.penalties * w, out[n : 2 * n] + self.penalties

    def hessian(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The Hessian at ``w`` times ``v``."""
        n = self.size + 1

        def terms(rows, at, value, label, weight):
            z, along = _products(rows, at, value, w, v)
            p = _sigmoid(z)
            return np.append(np.bincount(at, value * np.repeat(weight * p * (1 - p) * along, rows), n), 0.0)

        return self._sums(terms, 1)[:n] + self.penalties * v


def _products(rows, at, value, w, v=None):
    first = np.concatenate([[0], np.cumsum(rows)[:-1]])
    z = np.add.reduceat(value * w[at], first)
    return z, None if v is None else np.add.reduceat(value * v[at], first)


def _sigmoid(z):
    return np.where(z >= 0, 1.0, np.exp(-np.abs(z))) / (1 + np.exp(-np.abs(z)))


def _direction(problem: Problem, w, g, diagonal, radius: float, limit: int, tol: float):
    """Steihaug's conjugate gradients: a step within the radius, and the model's gain."""
    scale = 1 / np.maximum(diagonal, 1e-12)
    norm = lambda x: np.sqrt(float(x @ (x / scale)))
    step, left = np.zeros_like(w), -g
    z = left * scale
    d, gain = z.copy(), float(left @ z)
    # No step is solved further than the fit is to go.
    enough = max(min(0.1, np.sqrt(np.abs(g).max())) * np.linalg.norm(g), 0.3 * tol)
    for _ in range(limit):
        if np.linalg.norm(left) <= enough:
            break
        hd = problem.hessian(w, d)
        curve = float(d @ hd)
        alpha = gain / max(curve, 1e-300)
        if curve <= 0 or norm(step + alpha * d) >= radius:
            # To the border, measured like the radius.
            a, b, c = norm(d) ** 2, float(step @ (d / scale)), norm(step) ** 2 - radius**2
            alpha = (-b + np.sqrt(max(b * b - a * c, 0.0))) / a
            step, left = step + alpha * d, left - alpha * hd
            break
        step, left = step + alpha * d, left - alpha * hd
        z = left * scale
        now = float(left @ z)
        d, gain = z + (now / gain) * d, now
    return step, 0.5 * float(step @ (left - g)), norm(step)


def fit(
    blocks: DataFrame, size: int, penalty: float = 1.0, tol: float = 1e-6, max_steps: int = 100,
    start: np.ndarray | None = None,
) -> Fit:
    """Minimise until no part of the gradient exceeds ``tol``."""
    problem = Problem(blocks, size, penalty)
    w = np.zeros(size + 1) if start is None else start.copy()
    loss, g, diagonal = problem.at(w)
    radius, steps = np.inf, 0
    while np.abs(g).max() > tol and steps < max_steps:
        steps += 1
        step, expected, length = _direction(problem, w, g, diagonal, radius, 2 * size + 20, tol)
        new = problem.at(w + step)
        gained = loss - new[0]
        # Close to the optimum the loss is flat to rounding, and the gradient decides.
        flat = expected <= 1e-9 * max(1.0, abs(loss))
        good = gained >= 1e-4 * expected or (flat and np.abs(new[1]).max() < np.abs(g).max())
        if gained < 0.25 * expected and not flat:
            radius = 0.25 * length
        elif gained > 0.75 * expected and length >= 0.99 * radius:
            radius = 2 * radius
        if good:
            w, (loss, g, diagonal) = w + step, new
        elif flat:
            break
    return Fit(w, float(np.abs(g).max()), steps, problem.passes)
