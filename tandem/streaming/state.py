"""Where a stream keeps its state."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

_STORE = "spark.sql.streaming.stateStore."
_SETTINGS = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All stores of an executor share one bounded part of its memory.
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.maxMemoryUsageMB": "128",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started within keep their state in RocksDB, which timers need and whose memory
    does not grow with the keys; a query keeps the store that it was started with."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
