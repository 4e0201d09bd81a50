"""Local session for tests and trials."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(cores: str = "8", partitions: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tandem-tests")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tandem-ckpt-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
