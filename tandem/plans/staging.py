"""Intermediate tables written once and read many times.

They live under the folder the session names in ``spark.checkpoint.dir``, which on
a cluster is shared storage, so a lost executor costs only its own tasks.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Temporary folders of local sessions, by application.
_LOCAL: dict = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder of the session.

    ``spark.checkpoint.dir`` names it, or else the checkpoint folder set on the context.
    Where neither is set, a session whose executors are threads of the driver gets a
    temporary folder of its own; any other session is refused, since its executors would
    write to folders that nobody else sees.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = _LOCAL.setdefault(sc.applicationId, None) or tempfile.mkdtemp(prefix="tandem-")
        _LOCAL[sc.applicationId] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tandem/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
