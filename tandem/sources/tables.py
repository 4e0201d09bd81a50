"""Reading the tables of a data folder with only the columns a job needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan whose files split into fewer tasks than there are cores.

    A table of many files or row groups already has more tasks and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spread(table(spark, folder, "documents", *columns))
