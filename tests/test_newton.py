"""Newton's method on packed rows against dense linear algebra."""

import numpy as np
from pyspark.ml.linalg import Vectors

from tandem.operators import newton


def data(seed=0, n=400, d=60):
    rng = np.random.default_rng(seed)
    x = rng.poisson(0.4, size=(n, d)) * rng.choice([1.0, 30.0], size=d)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1])))).astype(float)
    return x, y, rng.uniform(0.5, 2, n)


def gradient(x, y, weight, w):
    full = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-(full @ w)))
    return full.T @ (weight * (p - y)) + np.append(w[:-1], 0)


def packed(spark, x, y, weight):
    rows = []
    for row, label, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        some = {i: v for i, v in enumerate(row) if v}
        vector = Vectors.dense(row) if len(rows) % 5 == 0 else Vectors.sparse(len(row), some)
        rows.append((vector, label, w))
    return newton.pack(spark.createDataFrame(rows, ["features", "label", "weight"]), x.shape[1])


def test_gradient_vanishes(spark, monkeypatch):
    x, y, weight = data()
    blocks = packed(spark, x, y, weight)
    fit = newton.fit(blocks, x.shape[1])
    assert fit.gradient <= 1e-6 and fit.steps < 40
    assert np.abs(gradient(x, y, weight, fit.weights)).max() < 1e-5
    # Sums added in parts by a shuffle are the same.
    monkeypatch.setattr(newton, "DRIVER_BYTES", 0)
    monkeypatch.setattr(newton, "PART", 17)
    problem = newton.Problem(blocks, x.shape[1], 1.0)
    w = np.linspace(-0.1, 0.1, x.shape[1] + 1)
    assert np.allclose(problem.at(w)[1], gradient(x, y, weight, w))


def test_hessian_products(spark):
    x, y, weight = data(1, 120, 15)
    problem = newton.Problem(packed(spark, x, y, weight), 15, 1.0)
    rng = np.random.default_rng(2)
    w, v = rng.normal(size=16) * 0.1, rng.normal(size=16)
    full = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-(full @ w)))
    h = full.T @ (full * (weight * p * (1 - p))[:, None]) + np.diag(np.append(np.ones(15), 0))
    assert np.allclose(problem.hessian(w, v), h @ v)
    assert np.allclose(problem.at(w)[2], np.diag(h))


def test_model_of_spark(spark):
    x, y, weight = data(3, 80, 5)
    fit = newton.fit(packed(spark, x, y, weight), 5)
    model = fit.model(spark)
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x.tolist()], ["features"])
    got = [r.probability[1] for r in model.transform(df).collect()]
    full = np.hstack([x, np.ones((len(x), 1))])
    assert np.allclose(got, 1 / (1 + np.exp(-(full @ fit.weights))))
