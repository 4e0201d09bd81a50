"""Several writers of one registry."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.classification import LogisticRegressionModel

from tandem.operators import models as ml
from tandem.operators import registry as rg


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame([(float(i), i > 4) for i in range(10)], "x double, y boolean")
    return ml.fit_logistic(ml.assemble(rows, ["x"]), "features", "y", tol=1e-6)


def at_once(n, work):
    gate = threading.Barrier(n)

    def run(i):
        gate.wait()
        return work(i)

    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(run, range(n)))


def test_one_of_many_gets_the_file(spark, tmp_path):
    path = str(tmp_path / "a folder" / "7")
    got = at_once(16, lambda i: rg.put_if_absent(spark, path))
    assert sorted(got) == [False] * 15 + [True]
    assert rg.claimed(spark, str(tmp_path / "a folder")) == 7 and rg.claimed(spark, str(tmp_path / "no")) == 0


def test_writers_at_once_lose_no_version(spark, tmp_path, model, monkeypatch):
    root = str(tmp_path / "reg")
    # All see the same last number, as writers do that read before any has claimed.
    monkeypatch.setattr(rg, "claimed", lambda *a: 0)
    names = at_once(4, lambda i: rg.Registry(spark, root).register(model, {"w": i}, {"f1": i / 10}, "abc"))
    reg = rg.Registry(spark, root)
    assert sorted(names) == reg.versions() == ["v1", "v2", "v3", "v4"]
    for i, name in enumerate(names):
        assert reg.manifest(name).params == {"w": str(i)}
        assert reg.load_model(name, LogisticRegressionModel).numFeatures == 1
    at_once(4, lambda i: rg.Registry(spark, root).promote(names[i], "production"))
    moves = reg.alias_events.collect()
    assert sorted(m.seq for m in moves) == [1, 2, 3, 4]
    assert reg.stage_of("production") == f"v{max(moves, key=lambda m: m.seq).version}"


def test_a_writer_that_fails_leaves_a_gap(spark, tmp_path, model):
    reg = rg.Registry(spark, str(tmp_path / "reg"))

    class Broken:
        def write(self):
            raise OSError("no space")

    with pytest.raises(OSError):
        reg.register(Broken(), {}, {}, "abc")
    assert reg.versions() == []
    assert reg.register(model, {}, {}, "abc") == "v2" and reg.versions() == ["v2"]


def test_tables_of_one_writer_stay_readable(spark, tmp_path, model):
    reg = rg.Registry(spark, str(tmp_path / "reg"))
    row = (3, {"a": "b"}, {"f1": 1.0}, "abc", None)
    spark.createDataFrame([row], rg.VERSION_SCHEMA).write.parquet(f"{reg.root}/model_versions")
    assert reg.register(model, {}, {}, "abc") == "v4" and reg.versions() == ["v3", "v4"]
