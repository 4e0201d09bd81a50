"""Append-only model registry: immutable versions, movable aliases, fingerprints."""

from __future__ import annotations

import os
import re
from datetime import datetime, timezone
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = ("staging", "production")
VERSION_SCHEMA = (
    "version int, params map<string,string>, metrics map<string,double>, "
    "dataset_hash string, created_at timestamp"
)
ALIAS_SCHEMA = "stage string, version int, seq bigint, at timestamp"

_LANES = 4
_LANE_HEX = 15


def fingerprint(df: DataFrame, row_id: str, columns: list[str], by: list[str] = ()) -> DataFrame:
    """One hash of a data set: (by, n_rows, dataset_hash).

    Each row, its id included, is hashed; the row hashes are cut into lanes that are
    summed, and the sums are hashed. Sums need a fixed-size buffer and combine before
    the shuffle, so no task holds the row hashes. Any change of a value, of a row or
    of a row's id changes the result; the physical order of rows does not.
    """
    # Each value is hashed by itself, so that no value can look like two or like a null.
    shown = [
        F.coalesce(F.sha2(F.col(c).cast("string").cast("binary"), 256), F.lit("-"))
        for c in [row_id, *columns]
    ]
    rows = df.select(*by, F.sha2(F.concat_ws(",", *shown), 256).alias("_h"))
    lane = lambda i: F.conv(
        F.substring("_h", 1 + i * _LANE_HEX, _LANE_HEX), 16, 10
    ).cast("decimal(28,0)")
    sums = [F.sum(lane(i)).cast("string").alias(f"_s{i}") for i in range(_LANES)]
    grouped = rows.groupBy(*by) if by else rows.groupBy()
    out = grouped.agg(F.count("*").alias("n_rows"), *sums)
    parts = [F.col("n_rows").cast("string")] + [
        F.coalesce(F.col(f"_s{i}"), F.lit("0")) for i in range(_LANES)
    ]
    return out.select(*by, "n_rows", F.sha2(F.concat_ws("|", *parts), 256).alias("dataset_hash"))


def versions_in_order(versions: DataFrame) -> DataFrame:
    """Versions by number, so that v10 follows v9, with their display name."""
    return versions.withColumn("name", F.concat(F.lit("v"), F.col("version").cast("string"))).orderBy(
        "version"
    )


def current_aliases(events: DataFrame) -> DataFrame:
    """Version each stage points to: the one of its latest event."""
    return events.groupBy("stage").agg(
        F.max_by("version", "seq").alias("version"), F.max("seq").alias("seq")
    )


def valid_events(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Alias events of a known stage that point to an existing version."""
    return events.where(F.col("stage").isin(*STAGES)).join(
        versions.select("version").distinct(), "version", "left_semi"
    )


def registry_report(versions: DataFrame, events: DataFrame) -> DataFrame:
    """Every version with the stages that point to it."""
    stages = (
        current_aliases(events)
        .groupBy("version")
        .agg(F.array_join(F.array_sort(F.collect_list("stage")), ",").alias("stage"))
    )
    return versions.join(stages, "version", "left").withColumn(
        "stage", F.coalesce("stage", F.lit(""))
    )


def put_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file, or return False if it is there already.

    Of several writers at once, on one machine or on many, exactly one gets True. Stores that
    Hadoop reaches create a file without overwriting in one step; its local file system looks
    first and creates then, so local files are created by the operating system.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        local = unquote(urlparse(str(fs.makeQualified(target).toUri().toString())).path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        # The exception's class depends on the store; what counts is whether the file is there.
        if not fs.exists(target):
            raise
        return False
    return True


def claimed(spark: SparkSession, folder: str) -> int:
    """The highest number claimed in ``folder``, 0 without any. Names only are listed."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return 0
    names = (entry.getPath().getName() for entry in fs.listStatus(target))
    return max((int(n) for n in names if re.fullmatch(r"\d+", n)), default=0)


class Registry:
    """Registry kept in tables under ``root``, for any number of writers.

    A version is made in two steps. Its writer first claims the number, by a file that only
    one writer can create, and then saves the model and publishes the manifest in a folder of
    that number: no two writers ever write to the same place. A writer that fails in between
    leaves a number that no version has. Alias moves claim their place in the order likewise.

    Versions and alias moves are appended and never changed, so moving an alias back
    loses nothing.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            rows = self.spark.read.schema(schema).option("recursiveFileLookup", True)
            return rows.parquet(f"{self.root}/{name}")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _claim(self, name: str, last: int) -> int:
        """The first free number after ``last`` and after all claims, now this writer's."""
        folder = f"{self.root}/claims/{name}"
        number = max(last, claimed(self.spark, folder)) + 1
        while not put_if_absent(self.spark, f"{folder}/{number}"):
            number += 1
        return number

    def _publish(self, name: str, number: int, row: tuple, schema: str) -> None:
        rows = self.spark.createDataFrame([row], schema).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/{number}")

    @property
    def versions_table(self) -> DataFrame:
        return self._table("model_versions", VERSION_SCHEMA)

    @property
    def alias_events(self) -> DataFrame:
        return self._table("alias_events", ALIAS_SCHEMA)

    def register(self, model, params: dict, metrics: dict, dataset_hash: str) -> str:
        """Claim a version, save the model, publish its manifest and return the version's name."""
        last = self.versions_table.agg(F.max("version")).first()[0] or 0
        number = self._claim("model_versions", last)
        model.write().save(f"{self.root}/models/v{number}")
        row = (
            number,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()},
            dataset_hash,
            datetime.now(timezone.utc),
        )
        self._publish("model_versions", number, row, VERSION_SCHEMA)
        return f"v{number}"

    def versions(self) -> list[str]:
        return [r["name"] for r in versions_in_order(self.versions_table).collect()]

    def manifest(self, version: str):
        number = int(version[1:]) if version[1:].isdigit() else -1
        row = self.versions_table.where(F.col("version") == number).first()
        if row is None:
            raise KeyError(f"the registry has no version {version}")
        return row

    def load_model(self, version: str, loader):
        """Load a saved model with its Spark ML reader; only own versions are read."""
        self.manifest(version)
        return loader.load(f"{self.root}/models/{version}")

    def promote(self, version: str, stage: str) -> None:
        if stage not in STAGES:
            raise ValueError(f"{stage} is not one of {STAGES}")
        self.manifest(version)
        last = self.alias_events.agg(F.max("seq")).first()[0] or 0
        seq = self._claim("alias_events", last)
        row = (stage, int(version[1:]), seq, datetime.now(timezone.utc))
        self._publish("alias_events", seq, row, ALIAS_SCHEMA)

    def stage_of(self, stage: str) -> str | None:
        row = current_aliases(self.alias_events).where(F.col("stage") == stage).first()
        return None if row is None else f"v{row['version']}"

    def production_model(self, loader):
        version = self.stage_of("production")
        if version is None:
            raise LookupError("no version is in production")
        return self.load_model(version, loader)

    def report(self) -> DataFrame:
        return registry_report(self.versions_table, self.alias_events)
