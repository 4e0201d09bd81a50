"""How the model queries spread their work."""

import contextlib
import io

from pyspark.sql import functions as F

from tandem.operators import models as ml
from tandem.queries import model_queries as mq


def test_retrain_check_uses_all_tasks_and_trains_on_distinct_vectors(spark, monkeypatch):
    kind = F.col("id") % 4
    pairs = spark.range(400).select(
        F.col("id").alias("profile_id"), F.lit("o").alias("offer_id"), (kind / 4).alias("coverage"),
        kind.cast("double").alias("missing"), (kind - 1).cast("double").alias("margin"),
        F.lit(2.0).alias("width"), (kind >= 3).alias("y"),
    )
    staged, real = [], mq.stage_table
    monkeypatch.setattr(mq, "scored_pairs", lambda s, sf: pairs)
    monkeypatch.setattr(mq, "stage_table", lambda df, name: staged.append((name, df)) or real(df, name))
    out = mq.retrain_check(spark, "").first()
    assert tuple(out) == (100, 0)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = [df.rdd.getNumPartitions() for name, df in staged if name == "retrain"]
    assert min(counts) > tasks and len(set(counts)) == 2
    assert [df.count() for name, df in staged if name == "retrain-classes"] == [4, 4]


def test_the_norm_of_a_vector_is_added_up_once(spark):
    rows = [("good word here", True), ("bad word there", False)] * 4
    df = spark.createDataFrame(rows, "text string, y boolean").withColumn("i", F.monotonically_increasing_id())
    out, _ = ml.TextClassifier().fit(df, "text", "y").vectors(df, "i", "text")
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        out.explain()
    made = [line for line in said.getvalue().splitlines() if "AS features" in line]
    assert made and not any("aggregate(" in line for line in made)
    assert all(abs(sum(v * v for v in r.features["values"]) - 1) < 1e-12 for r in out.collect())


def test_models_are_trained_on_all_rows(spark, monkeypatch):
    """A sample of rows would lack the words that only the others have."""
    real, trained = ml.training_sample, []
    monkeypatch.setattr(ml, "training_sample", lambda df, text, *_: real(df, text, 10))
    fit = ml.network.fit
    monkeypatch.setattr(ml.network, "fit", lambda df, *a: trained.append(df.count()) or fit(df, *a))
    rows = [(i, f"{'good' if i % 2 else 'bad'} own{i}", bool(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "i long, text string, y boolean")
    for model, pairs in ((ml.WordModel(), 0), (ml.TextClassifier(), 60)):
        assert model.fit(df, "text", "y").terms.count() == 62 + pairs
    assert ml.compare_models(df, "i", "text", "y", epochs=1).count() == 60
    assert trained == [60]
